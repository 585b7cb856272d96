"""A read-only, paged JSON API as a Spark data source.

    spark.dataSource.register(LedgerPages)
    spark.read.format("ledger_pages").schema(JOURNAL).options(base="https://...", path="journals", key="journals", token=...).load()

The page count comes from the first page; `readers` partitions share the others, and the pace that a token allows. Requests are
retried, and only https GETs under the base path are ever made, redirects included. `max_items` is a limit that is pushed
down to pages, `param.<name>` goes into the query of every request.

With `date_column` or `id_column` filters on that column become requests: a closed range of days, in spans that the service allows,
and lists of ids, in lists that it allows. `spark.sql.python.filterPushdown.enabled` must be true for it; Spark still applies
every filter to what comes back.
"""

from __future__ import annotations

import datetime
import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The service's pace and patience.
SPACING_S = 0.4
ATTEMPTS = 5
IDS_PER_REQUEST = 50
LONGEST_SPAN_DAYS = 366
REFRESH_MARGIN_S = 300
TOKEN_LIFE_S = 3600
EXCHANGES = 3
EXCHANGE_WAIT_S = 60
# End of fixed values.


class ForbiddenRequest(ValueError):
    """A request that a read-only client must not make."""


def allowed(method: str, url: str, base: str) -> str:
    """url, if it is an https GET without user info on the base's host and under its path."""
    u, b = urllib.parse.urlsplit(url), urllib.parse.urlsplit(base)
    path = urllib.parse.unquote(u.path)
    if method != "GET" or u.scheme != "https" or u.username or u.password or u.port not in (None, 443) or u.hostname != b.hostname:
        raise ForbiddenRequest(f"{method} {u.scheme}://{u.hostname} is not allowed")
    if ".." in path.split("/") or not path.startswith(b.path.rstrip("/") + "/"):
        raise ForbiddenRequest("path outside the base path")
    return url


class _Redirects(urllib.request.HTTPRedirectHandler):
    def __init__(self, base: str):
        self.base = base

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        allowed(req.get_method(), newurl, self.base)
        return super().redirect_request(req, fp, code, msg, headers, newurl)


def http(url: str, headers: dict, base: str) -> tuple[int, dict, bytes]:
    opener = urllib.request.build_opener(_Redirects(base))
    try:
        with opener.open(urllib.request.Request(url, headers=headers), timeout=30) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), b""


def wait_after(status: int | None, attempt: int, headers: dict) -> float | None:
    """Seconds to wait before the next attempt, None if it makes no sense: no answer 2^n, 429 as told or 2^(n+1), 5xx 2^(n+1)."""
    if status is None:
        return float(2**attempt)
    if status == 429:
        told = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
        return float(told) if told.replace(".", "", 1).isdigit() else float(2 ** (attempt + 1))
    return float(2 ** (attempt + 1)) if status >= 500 else None


class RequestFailed(RuntimeError):
    """A request that was answered with an error, or not at all (status None). The message names no values."""

    def __init__(self, path: str, status: int | None):
        super().__init__(f"GET {path}: status {status}")
        self.status = status


class TokenProvider:
    """Short-lived tokens for a key: kept in memory, renewed REFRESH_MARGIN_S before they end, three attempts.

    exchange(key) gives (status, body); the key and the tokens are never shown.
    """

    def __init__(self, key: str, exchange, sleep=time.sleep, clock=time.monotonic):
        self._key, self._exchange, self._sleep, self._clock = key, exchange, sleep, clock
        self._token, self._ends = None, 0.0

    def __repr__(self) -> str:
        return "TokenProvider(...)"

    def get(self) -> str:
        if self._token is None or self._clock() >= self._ends - REFRESH_MARGIN_S:
            self._token, life = self._renew()
            self._ends = self._clock() + life
        return self._token

    def forget(self) -> None:
        self._token = None

    def _renew(self) -> tuple[str, float]:
        status = None
        for attempt in range(EXCHANGES):
            try:
                status, body = self._exchange(self._key)
            except OSError:
                status, body = None, {}
            if status == 200:
                return body["access_token"], float(body.get("expires_in", TOKEN_LIFE_S))
            if status is not None and status != 429 and status < 500:
                raise PermissionError(f"no token: status {status}")
            self._sleep(EXCHANGE_WAIT_S if status == 429 else 2.0**attempt)
        raise PermissionError(f"no token after {EXCHANGES} attempts: status {status}")


class Client:
    """GETs pages; transport(url, headers, base) and sleep can be replaced. token: a text or a TokenProvider, which is asked for
    another token once if one is refused. spacing: seconds between two requests of this client."""

    def __init__(self, base: str, token: str | TokenProvider = "", transport=http, sleep=time.sleep, clock=time.monotonic, spacing: float = SPACING_S):
        self.base, self.token, self.transport, self.sleep, self.clock, self.spacing = base.rstrip("/"), token, transport, sleep, clock, spacing
        self.last = None

    def get(self, path: str, params: dict) -> dict:
        url = allowed("GET", f"{self.base}/{path}?{urllib.parse.urlencode(params, doseq=True)}", self.base)
        renewed = False
        for attempt in range(ATTEMPTS):
            if self.last is not None and (rest := self.spacing - (self.clock() - self.last)) > 0:
                self.sleep(rest)
            self.last = self.clock()
            token = self.token.get() if isinstance(self.token, TokenProvider) else self.token
            try:
                status, headers, body = self.transport(url, {"Authorization": f"Bearer {token}", "Accept": "application/json"}, self.base)
            except OSError:
                status, headers, body = None, {}, b""
            if status == 200:
                return json.loads(body)
            if status == 401 and not renewed and isinstance(self.token, TokenProvider):
                self.token.forget()
                renewed = True
                continue
            wait = wait_after(status, attempt, headers)
            if wait is None or attempt == ATTEMPTS - 1:
                raise RequestFailed(path, status)
            self.sleep(wait)
        raise RequestFailed(path, 401)

    def pages(self, path: str, key: str, params: dict | None = None, per_page: int = 500, max_items: int | None = None) -> tuple[list, dict]:
        """(items, meta) of all pages, or of as many as max_items needs; meta has total_count, total_pages, pages_fetched,
        fetched_count and truncated."""
        items, page, meta = [], 0, {}
        while True:
            page += 1
            body = self.get(path, (params or {}) | {"page": page, "per_page": per_page})
            got, meta = body.get(key) or [], body.get("metadata") or {}
            items += got
            if max_items is not None and len(items) >= max_items:
                items = items[:max_items]
                break
            if not got or page >= int(meta.get("total_pages") or 0):
                break
        total = meta.get("total_count")
        return items, {"total_count": total, "total_pages": meta.get("total_pages"), "pages_fetched": page, "fetched_count": len(items), "truncated": total is not None and len(items) < int(total)}


def masters(client: Client, endpoints: list[tuple[str, str]]) -> tuple[dict, dict]:
    """(bodies, outcome) by name of master endpoints (name, path): what is forbidden or not there is noted and passed over, any
    other failure raises."""
    bodies, outcome = {}, {}
    for name, path in endpoints:
        try:
            bodies[name] = client.get(path, {})
            outcome[name] = "read"
        except RequestFailed as e:
            if e.status not in (403, 404):
                raise
            outcome[name] = str(e.status)
    return bodies, outcome


def counts(client: Client, path: str, key: str, periods: list[dict]) -> list[dict]:
    """Per period (start_date, end_date, ...) its total_count, from the metadata of a page of one item."""
    return [p | {"total_count": client.pages(path, key, {"start_date": p["start_date"], "end_date": p["end_date"]}, 1, 1)[1]["total_count"]} for p in periods]


class Page(InputPartition):
    """Pages number, number + slots, ... to last, or the items of a page that is here already."""

    def __init__(self, number: int, last: int = 0, slots: int = 1, items: list | None = None):
        self.number, self.last, self.slots, self.items = number, last, slots, items


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [(f.name, f.dataType) for f in schema.fields]
        o = dict(options)
        self.base, self.path, self.key, self.token = o["base"], o["path"], o["key"], o.get("token", "")
        self.per_page, self.most = int(o.get("per_page", 500)), int(o["max_items"]) if "max_items" in o else None
        self.params = {k.removeprefix("param."): v for k, v in o.items() if k.startswith("param.")}
        self.transport, self.readers = o.get("transport"), max(1, int(o.get("readers", 8)))

    def _client(self, slots: int = 1) -> Client:
        transport = http
        if self.transport:
            module, _, name = self.transport.partition(":")
            transport = getattr(importlib.import_module(module), name)
        return Client(self.base, self.token, transport, spacing=SPACING_S * slots)

    def partitions(self):
        """Pages, dealt to at most `readers` partitions, each of which waits so many times longer between its requests: the
        token's pace holds for all of them together. What the first page brought is not asked for again."""
        first = self._client().get(self.path, self.params | {"page": 1, "per_page": self.per_page})
        got = first.get(self.key) or []
        pages = int(first.get("metadata", {}).get("total_pages") or (1 if got else 0))
        if self.most is not None:
            pages = min(pages, -(-self.most // self.per_page))
        if not pages:
            return [Page(0)]
        slots = min(self.readers, max(1, pages - 1))
        return [Page(1, items=got[: self.most]), *(Page(n, pages, slots) for n in range(2, 2 + min(slots, pages - 1)))]

    def read(self, partition):
        if not partition.number:
            return
        if partition.items is not None:
            yield from (tuple(_cast(item.get(n), t) for n, t in self.columns) for item in partition.items)
            return
        client = self._client(partition.slots)
        for page in range(partition.number, partition.last + 1, partition.slots):
            got = client.get(self.path, self.params | {"page": page, "per_page": self.per_page}).get(self.key) or []
            left = None if self.most is None else max(0, self.most - (page - 1) * self.per_page)
            yield from (tuple(_cast(item.get(n), t) for n, t in self.columns) for item in got[:left])


def _cast(value, kind):
    """JSON values in the shape Spark's rows take: dates from their texts, nested objects as tuples of their schema's fields."""
    name = kind.typeName()
    if value is None:
        return None
    if name == "struct":
        return tuple(_cast(value.get(f.name), f.dataType) for f in kind.fields)
    if name == "array":
        return [_cast(v, kind.elementType) for v in value]
    if name == "date":
        return datetime.date.fromisoformat(value[:10])
    return value if name != "string" or isinstance(value, str) else json.dumps(value)


class Scans(InputPartition):
    """Requests by their parameters, each walked page by page."""

    def __init__(self, params: list[dict], slots: int):
        self.params, self.slots = params, slots


class _FilteredReader(_Reader):
    """A reader whose requests follow the filters on a date and an id column.

    Days count if both ends are known, by filters or by options; without them the service sees no dates. Each span of days meets each list of ids in one request of
    its own, so that a row comes once. A limit on items is a limit on what the options ask for, so that with one nothing is pushed.
    """

    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.date_column, self.id_column = options.get("date_column"), options.get("id_column")
        self.id_param = options.get("id_param", "transaction_ids")
        self.first, self.last, self.ids = self.params.get("start_date"), self.params.get("end_date"), None

    def pushFilters(self, filters):
        day = lambda v: v.isoformat()[:10] if isinstance(v, datetime.date) else v if isinstance(v, str) and len(v) == 10 else None
        for f in filters if self.most is None else ():
            kind, value = type(f).__name__, getattr(f, "value", None)
            column = ".".join(getattr(f, "attribute", ()))
            if column == self.date_column and (d := day(value)) and kind in ("EqualTo", "EqualNullSafe", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"):
                # Days after or before a day are asked for with it: the filter that stays takes it out again.
                if not kind.startswith("Less"):
                    self.first = max(self.first or d, d)
                if not kind.startswith("Greater"):
                    self.last = min(self.last or d, d)
            elif column == self.id_column and kind in ("EqualTo", "EqualNullSafe", "In"):
                values = {str(v) for v in (value if kind == "In" else (value,)) if v is not None}
                self.ids = values if self.ids is None else self.ids & values
        return list(filters)

    def requests(self) -> list[dict]:
        """The parameters of each scan."""
        fixed = {k: v for k, v in self.params.items() if k not in ("start_date", "end_date")}
        spans = [{"start_date": a, "end_date": b} for a, b in year_spans(self.first, self.last)] if self.first and self.last else [{k: v for k, v in self.params.items() if k not in fixed}]
        lists = [{}] if self.ids is None else [{self.id_param: ",".join(part)} for part in id_batches(sorted(self.ids))]
        return [fixed | span | ids for span in spans for ids in lists]

    def partitions(self):
        """One scan goes page by page to the readers; several go to them whole, so that planning asks for nothing."""
        scans = self.requests()
        if len(scans) == 1:
            self.params = scans[0]
            return super().partitions()
        slots = max(1, min(self.readers, len(scans)))
        return [Scans(scans[i::slots], slots) for i in range(slots)] if scans else [Page(0)]

    def read(self, partition):
        if not isinstance(partition, Scans):
            yield from super().read(partition)
            return
        client = self._client(partition.slots)
        for params in partition.params:
            page, pages = 0, 1
            while page < pages:
                page += 1
                body = client.get(self.path, params | {"page": page, "per_page": self.per_page})
                got = body.get(self.key) or []
                yield from (tuple(_cast(item.get(n), t) for n, t in self.columns) for item in got)
                pages = int(body.get("metadata", {}).get("total_pages") or 0) if got else 0


def year_spans(first: str, last: str, days: int = LONGEST_SPAN_DAYS) -> list[tuple[str, str]]:
    """Closed spans of at most `days` days from end to end, one after the other, that make up first to last; none if last is before first."""
    at, end, out = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last), []
    while at <= end:
        to = min(end, at + datetime.timedelta(days=days))
        out.append((at.isoformat(), to.isoformat()))
        at = to + datetime.timedelta(days=1)
    return out


class LedgerPages(DataSource):
    @classmethod
    def name(cls):
        return "ledger_pages"

    def schema(self):
        raise ValueError("a schema must be given")

    def reader(self, schema):
        return (_FilteredReader if {"date_column", "id_column"} & set(self.options) else _Reader)(schema, self.options)


def id_batches(ids: list[str], size: int = IDS_PER_REQUEST) -> list[list[str]]:
    """IN-lists for one request each; ids come URL-encoded and are sent decoded."""
    plain = [urllib.parse.unquote(i) for i in ids]
    return [plain[a : a + size] for a in range(0, len(plain), size)]


def range_params(start: str, end: str, ids: list[str] | None = None) -> dict:
    """The query of a scan by date, at most LONGEST_SPAN_DAYS long, and of at most IDS_PER_REQUEST link ids, sent decoded."""
    if (datetime.date.fromisoformat(end) - datetime.date.fromisoformat(start)).days > LONGEST_SPAN_DAYS:
        raise ValueError("a scan spans at most a year")
    if ids and len(ids) > IDS_PER_REQUEST:
        raise ValueError(f"a request takes at most {IDS_PER_REQUEST} ids")
    return {"start_date": start, "end_date": end} | ({"transaction_ids": ",".join(urllib.parse.unquote(i) for i in ids)} if ids else {})


def scan_options(start: str, end: str, ids: list[str] | None = None) -> dict:
    """range_params as options of the data source."""
    return {f"param.{k}": v for k, v in range_params(start, end, ids).items()}
