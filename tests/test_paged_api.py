import json
import urllib.parse

import pytest

from ledgerloom.sources import paged_api as P

BASE = "https://ledger.example/api/v3"
DATA = [{"id": f"t{i}", "value": i, "side": "INCOME", "voucher_file_ids": ["v"]} for i in range(7)]


def pages(url, headers, base):
    q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
    n, size = int(q["page"]), int(q["per_page"])
    return 200, {}, json.dumps({"transactions": DATA[(n - 1) * size : n * size], "metadata": {"total_pages": -(-len(DATA) // size)}}).encode()


DATED = [{"id": f"t{i}", "date": f"{2020 + i % 5}-0{1 + i % 9}-11", "value": i} for i in range(120)]


def dated(url, headers, base):
    """A service that answers by dates and ids, refuses what it doesn't allow, and keeps a list of what it was asked."""
    import datetime

    q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
    with open(q["asked"], "a") as f:
        f.write(json.dumps(q) + "\n")
    rows, ids = DATED, q.get("transaction_ids", "").split(",") if "transaction_ids" in q else None
    if "start_date" in q:
        if (datetime.date.fromisoformat(q["end_date"]) - datetime.date.fromisoformat(q["start_date"])).days > 366:
            return 400, {}, b""
        rows = [r for r in rows if q["start_date"] <= r["date"] <= q["end_date"]]
    if ids is not None:
        if len(ids) > 50:
            return 400, {}, b""
        rows = [r for r in rows if r["id"] in ids]
    n, size = int(q["page"]), int(q["per_page"])
    return 200, {}, json.dumps({"transactions": rows[(n - 1) * size : n * size], "metadata": {"total_pages": -(-len(rows) // size)}}).encode()


def test_filters_become_requests(spark, tmp_path):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(P.LedgerPages)
    options = {"base": BASE, "path": "transactions", "key": "transactions", "per_page": 20, "transport": "tests.test_paged_api:dated", "date_column": "date", "id_column": "id", "param.asked": str(tmp_path / "asked")}
    table = lambda **more: spark.read.format("ledger_pages").schema("id string, date date, value long").options(**options, **more).load()
    asked_file = tmp_path / "asked"

    def ask(where, **more):
        asked_file.write_text("")
        got = sorted(r.id for r in table(**more).where(where).collect())
        asked = [json.loads(line) for line in asked_file.read_text().split("\n") if line]
        return got, asked

    want = lambda f: sorted(r["id"] for r in DATED if f(r))
    try:
        got, asked = ask("date >= '2021-03-01' and date <= '2021-06-30' and value > 10")
        assert got == want(lambda r: "2021-03-01" <= r["date"] <= "2021-06-30" and r["value"] > 10)
        assert {(q["start_date"], q["end_date"]) for q in asked} == {("2021-03-01", "2021-06-30")}
        got, asked = ask("date > '2020-02-11' and date < '2023-07-11'")
        assert got == want(lambda r: "2020-02-11" < r["date"] < "2023-07-11")
        assert sorted({(q["start_date"], q["end_date"]) for q in asked}) == P.year_spans("2020-02-11", "2023-07-11") and len({q["start_date"] for q in asked}) == 4
        some = [f"t{i}" for i in range(0, 120, 2)]
        got, asked = ask(f"id in ({','.join(repr(x) for x in some)}) and date = '2022-03-11'")
        assert got == want(lambda r: r["id"] in some and r["date"] == "2022-03-11")
        assert sorted(len(q["transaction_ids"].split(",")) for q in asked if q["page"] == "1") == [10, 50] and {q["start_date"] for q in asked} == {"2022-03-11"}
        got, asked = ask("date >= '2021-03-01'")  # one end only: nothing the service could be asked for
        assert got == want(lambda r: r["date"] >= "2021-03-01") and not any("start_date" in q for q in asked)
        got, asked = ask("date >= '2021-03-01'", **{"param.start_date": "2021-01-01", "param.end_date": "2021-12-31"})
        assert got == want(lambda r: "2021-03-01" <= r["date"] <= "2021-12-31") and {(q["start_date"], q["end_date"]) for q in asked} == {("2021-03-01", "2021-12-31")}
        assert ask("date > '2022-01-01' and date < '2021-01-01'") == ([], [])
        assert len(table(max_items=25).where("value >= 0").collect()) == 25
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_spans():
    assert P.year_spans("2020-01-01", "2021-01-01") == [("2020-01-01", "2021-01-01")]
    assert P.year_spans("2020-01-01", "2021-01-02") == [("2020-01-01", "2021-01-01"), ("2021-01-02", "2021-01-02")]
    assert P.year_spans("2020-01-02", "2020-01-01") == []


def test_source_reads_all_pages(spark):
    from ledgerloom.sources.snapshots import LINE_ITEM

    spark.dataSource.register(P.LedgerPages)
    r = spark.read.format("ledger_pages").schema(LINE_ITEM).options(base=BASE, path="transactions", key="transactions", per_page=3, transport="tests.test_paged_api:pages")
    rows = r.load()
    assert sorted(x.id for x in rows.collect()) == [d["id"] for d in DATA] and rows.rdd.getNumPartitions() == 3
    assert r.option("max_items", 4).load().count() == 4


@pytest.mark.parametrize(
    ("method", "url"),
    [("POST", BASE + "/x"), ("GET", "http://ledger.example/api/v3/x"), ("GET", "https://other.example/api/v3/x"), ("GET", "https://u:p@ledger.example/api/v3/x"),
     ("GET", "https://ledger.example:8443/api/v3/x"), ("GET", "https://ledger.example/api/v2/x"), ("GET", BASE + "/../v2/x"), ("GET", BASE + "/%2e%2e/v2/x"), ("DELETE", BASE + "/x")],
)
def test_only_reads_under_the_base(method, url):
    with pytest.raises(P.ForbiddenRequest):
        P.allowed(method, url, BASE)
    assert P.allowed("GET", BASE + "/journals?page=1", BASE)


def test_retries_and_spacing():
    answers = iter([(500, {}, b""), (429, {"Retry-After": "7"}, b""), OSError(), (200, {}, b"{}")])
    slept, now = [], [0.0]

    def transport(*_):
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    c = P.Client(BASE, transport=transport, sleep=lambda s: (slept.append(round(s, 2)), now.__setitem__(0, now[0] + s)), clock=lambda: now[0])
    assert c.get("x", {}) == {} and slept == [2.0, 7.0, 4.0]
    c.transport = lambda *_: (200, {}, b"{}")
    c.get("x", {})
    assert slept[-1] == 0.4
    c.transport = lambda *_: (404, {}, b"")
    with pytest.raises(RuntimeError):
        c.get("x", {})


def test_id_batches():
    assert P.id_batches([f"a%2F{i}" for i in range(51)])[1] == ["a/50"] and len(P.id_batches([f"{i}" for i in range(100)])) == 2


def test_refused_token_is_renewed_once():
    tokens = iter(["one", "two", "three"])
    provider = P.TokenProvider("key", lambda k: (200, {"access_token": next(tokens), "expires_in": 3600}), clock=lambda: 0.0)
    seen = []

    def transport(url, headers, base):
        seen.append(headers["Authorization"])
        return (200, {}, b"{}") if headers["Authorization"].endswith("two") else (401, {}, b"")

    c = P.Client(BASE, provider, transport, sleep=lambda s: None, clock=lambda: 0.0)
    assert c.get("x", {}) == {} and seen == ["Bearer one", "Bearer two"] and "key" not in repr(provider)
    c.transport = lambda *_: (401, {}, b"")
    with pytest.raises(P.RequestFailed):
        c.get("x", {})


def test_tokens_are_kept_and_renewed_early():
    now, slept, answers = [0.0], [], iter([(429, {}), OSError(), (200, {"access_token": "a", "expires_in": 1000}), (200, {"access_token": "b"}), (401, {})])

    def exchange(key):
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    p = P.TokenProvider("k", exchange, sleep=slept.append, clock=lambda: now[0])
    assert p.get() == "a" and slept == [60, 2.0]
    now[0] = 699.0
    assert p.get() == "a"
    now[0] = 700.0
    assert p.get() == "b"
    p.forget()
    with pytest.raises(PermissionError):
        p.get()


def test_pages_and_what_they_say():
    asked = []

    def transport(url, headers, base):
        asked.append(url)
        s, h, b = pages(url, headers, base)
        body = json.loads(b)
        body["metadata"]["total_count"] = len(DATA)
        return s, h, json.dumps(body).encode()

    c = P.Client(BASE, transport=transport, sleep=lambda s: None)
    items, meta = c.pages("transactions", "transactions", per_page=3)
    assert len(items) == 7 and meta == {"total_count": 7, "total_pages": 3, "pages_fetched": 3, "fetched_count": 7, "truncated": False}
    items, meta = c.pages("transactions", "transactions", per_page=3, max_items=4)
    assert len(items) == 4 and meta["pages_fetched"] == 2 and meta["truncated"]
    assert P.counts(c, "transactions", "transactions", [{"start_date": "2024-01-01", "end_date": "2024-12-31"}])[0]["total_count"] == 7


def test_masters_pass_over_what_is_forbidden():
    def transport(url, headers, base):
        return (403, {}, b"") if "secret" in url else (404, {}, b"") if "gone" in url else (200, {}, b'{"a": 1}')

    c = P.Client(BASE, transport=transport, sleep=lambda s: None)
    bodies, outcome = P.masters(c, [("a", "a"), ("b", "secret"), ("c", "gone")])
    assert bodies == {"a": {"a": 1}} and outcome == {"a": "read", "b": "403", "c": "404"}
    c.transport = lambda *_: (418, {}, b"")
    with pytest.raises(P.RequestFailed):
        P.masters(c, [("a", "a")])


def test_scan_parameters():
    assert P.range_params("2024-01-01", "2024-12-31", ["a%2Fb"]) == {"start_date": "2024-01-01", "end_date": "2024-12-31", "transaction_ids": "a/b"}
    assert P.scan_options("2024-01-01", "2024-01-02") == {"param.start_date": "2024-01-01", "param.end_date": "2024-01-02"}
    for bad in (("2024-01-01", "2025-02-01"), ("2024-01-01", "2024-01-02", ["x"] * 51)):
        with pytest.raises(ValueError):
            P.range_params(*bad)
