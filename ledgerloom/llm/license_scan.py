"""License recognition by sentence rules.

A text is split into sentences, and each is normalised (letters A-Z lower-cased, everything but letters and digits one blank), so
that line wraps and comment signs do not matter. Known licence sentences become identifiers, in their order; a sentence
that speaks of a licence in words that are not known becomes `unknown`. Ordered rules then match runs of identifiers, some of them
optional; each consumes what it matches and leaves a gap there, so that a full licence text is not also reported as its
parts and the sentences on either side of it don't meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_or_empty

#: Known sentences by identifier, normalised: whatever stands around these words in their sentence may vary.
SENTENCES = {
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied"],
    "no-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"],
    "isc-as-is": ["the software is provided as is and the author disclaims all warranties with regard to this software"],
    "isc-liability": ["in no event shall the author be liable for any special direct indirect or consequential damages"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms with or without modification are permitted"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice", "redistribution of source code must retain the above copyright notice"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice", "redistribution in binary form must reproduce the above copyright notice"],
    "bsd-names": ["may be used to endorse or promote products derived from this software without specific prior written permission", "may not be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-as-is": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties"],
    "bsd-liability": ["in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages", "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at"],
    "apache-as-is": ["distributed under the license is distributed on an as is basis without warranties or conditions of any kind"],
    "apache-limits": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl-free": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl-free": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "agpl-free": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"],
    "or-later-2": ["either version 2 of the license or at your option any later version", "either version 2 of the license or any later version"],
    "or-later-2.1": ["either version 2 1 of the license or at your option any later version"],
    "or-later-3": ["either version 3 of the license or at your option any later version", "either version 3 of the license or any later version"],
    "gpl-hope": ["is distributed in the hope that it will be useful but without any warranty"],
    "gpl-details": ["see the gnu general public license for more details", "see the gnu lesser general public license for more details", "see the gnu affero general public license for more details"],
    "gpl-copy": ["you should have received a copy of the gnu general public license", "you should have received a copy of the gnu lesser general public license", "you should have received a copy of the gnu affero general public license"],
    "mpl-terms": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at"],
    "unlicense-free": ["this is free and unencumbered software released into the public domain"],
    "unlicense-use": ["anyone is free to copy modify publish use compile sell or distribute this software"],
    "public-domain": ["dedicated to the public domain", "released into the public domain", "placed in the public domain"],
    "all-rights": ["all rights reserved"],
    "apache-title": ["apache license version 2 0 january 2004"],
    "apache-definitions": ["license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document"],
    "gpl-2-title": ["gnu general public license version 2 june 1991"], "gpl-3-title": ["gnu general public license version 3 29 june 2007"],
    "gpl-verbatim": ["everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"],
    "gpl-preamble": ["the gnu general public license is a free copyleft license for software and other kinds of works", "the licenses for most software are designed to take away your freedom to share and change it"],
}
#: Names that a sentence may give a licence, normalised. "<verb> under [the terms of] [the] <name>", or its SPDX line, names it.
NAMES = {
    "MIT": ["mit license", "mit licence", "mit x11 license", "expat license", "mit"],
    "ISC": ["isc license", "isc licence", "isc"],
    "0BSD": ["zero clause bsd license", "0bsd"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"],
    "BSD": ["bsd license", "bsd licence", "bsd style license"],
    "Apache-2.0": ["apache license version 2 0", "apache license v2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"],
    "Apache": ["apache license", "apache licence"],
    "GPL-2.0-or-later": ["gnu general public license version 2 or later", "gnu general public license v2 or later", "gnu gpl v2 or later", "gpl 2 0 or later"],
    "GPL-3.0-or-later": ["gnu general public license version 3 or later", "gnu general public license v3 or later", "gnu gpl v3 or later", "gpl 3 0 or later"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2 0", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gplv2", "gpl 2 0 only", "gpl 2 0"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3 0", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gplv3", "gpl 3 0 only", "gpl 3 0"],
    "GPL": ["gnu general public license", "gnu gpl", "gpl"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 2 1", "lgplv2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl 3 0 only", "lgpl 3 0 or later", "lgpl 3 0", "lgplv3"],
    "LGPL": ["gnu lesser general public license", "lgpl"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3", "agpl 3 0 only", "agpl 3 0 or later", "agpl 3 0", "agplv3"],
    "AGPL": ["gnu affero general public license", "agpl"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"],
    "CC0-1.0": ["creative commons zero license", "cc0 1 0", "cc0"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"],
    "CC-BY-NC-ND-4.0": ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["wtfpl"],
    "Zlib": ["zlib license", "zlib"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license", "bsl 1 0"],
    "EUPL-1.2": ["eupl version 1 2", "eupl v 1 2", "eupl v1 2", "eupl 1 2", "european union public licence version 1 2", "european union public licence v 1 2"],
    "Artistic-2.0": ["artistic license version 2 0", "artistic license 2 0", "artistic 2 0"],
    "Artistic": ["artistic license"],
}
#: How a name goes on where any later version will do.
LATER = ["or later", "or any later version", "or at your option any later version", "or newer"]
for _kind, _names in (("GPL", ["gnu general public license", "gnu gpl", "gpl"]), ("LGPL", ["gnu lesser general public license", "lgpl"]), ("AGPL", ["gnu affero general public license", "agpl"])):
    for _version in ("2.0", "2.1", "3.0"):
        _short_version = _version.removesuffix(".0").replace(".", " ")
        _forms = [f"{n} {v}" for n in _names for v in (f"version {_short_version}", f"v{_short_version}", _version.replace(".", " "), _short_version)] + [f"{_names[-1]}v{_short_version}"]
        NAMES[f"{_kind}-{_version}-or-later"] = sorted({f"{f} {later}" for f in _forms for later in LATER} | set(NAMES.get(f"{_kind}-{_version}-or-later", [])))
for _terms in ("by-nc-sa", "by-nc-nd", "by-nc", "by-sa", "by-nd", "by"):
    SENTENCES[f"named-CC-{_terms.upper()}-4.0"] = [f"creativecommons org licenses {_terms.replace('-', ' ')} 4 0"]
SENTENCES["named-CC0-1.0"] = ["creativecommons org publicdomain zero 1 0"]
for _i, _ns in NAMES.items():  # a name belongs to one licence: the later version's forms are no forms of the version alone
    if not _i.endswith("-or-later"):
        NAMES[_i] = [n for n in _ns if not n.endswith("or later")]
VERBS = ["licensed", "released", "available", "distributed", "published", "provided", "covered", "redistributed", "shared", "offered"]
#: In order; the first rule that matches takes its run. An identifier with "?" may be missing; "|" stands between alternatives.
RULES = [
    ("MIT", ["mit-grant", "mit-notice?", "as-is", "no-liability?"]), ("MIT", ["mit-grant", "mit-notice?"]),
    ("ISC", ["isc-grant", "mit-notice?", "isc-as-is", "isc-liability?"]), ("ISC", ["isc-grant"]),
    ("BSD-3-Clause", ["all-rights?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is?", "bsd-liability?"]),
    ("BSD-2-Clause", ["all-rights?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is?", "bsd-liability?"]),
    ("Apache-2.0", ["apache-title", "apache-definitions?", "named-Apache-2.0?", "apache-comply?", "apache-copy?", "apache-as-is?", "apache-limits?"]),
    ("GPL-3.0", ["gpl-3-title", "gpl-verbatim?", "gpl-preamble?"]), ("GPL-2.0", ["gpl-2-title", "gpl-verbatim?", "gpl-preamble?"]),
    ("Apache-2.0", ["named-Apache-2.0", "apache-comply?", "apache-copy?", "apache-as-is?", "apache-limits?"]),
    ("AGPL-3.0-or-later", ["agpl-free", "or-later-3", "gpl-hope?", "gpl-details?", "gpl-copy?"]), ("AGPL", ["agpl-free", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "or-later-3", "gpl-hope?", "gpl-details?", "gpl-copy?"]), ("LGPL-2.1-or-later", ["lgpl-free", "or-later-2.1", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("LGPL", ["lgpl-free", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("GPL-3.0-or-later", ["gpl-free", "or-later-3", "gpl-hope?", "gpl-details?", "gpl-copy?"]), ("GPL-2.0-or-later", ["gpl-free", "or-later-2", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("GPL", ["gpl-free", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("MPL-2.0", ["mpl-terms|named-MPL-2.0", "mpl-copy?"]),
    ("Unlicense", ["unlicense-free", "unlicense-use?"]), ("PublicDomain", ["public-domain"]),
    *((name, [f"named-{name}"]) for name in NAMES),
    ("LicenseRef-Proprietary", ["all-rights"]),
]
#: Every known or unknown licence sentence holds one of these, so that other texts need no splitting.
TRIGGERS = ["licens", "licenc", "permi", "warrant", "copyright", "redistribut", "reserved", "public domain", "publicdomain", "liable", "gnu", "mpl was not", "anyone is free", "(?:" + "|".join(VERBS) + ") under"]
#: And every trigger one of these, which are looked for first, as plain text.
STEMS = ["licen", "permi", "warrant", "copyright", "redistribut", "reserved", "domain", "liable", "gnu", "mpl", "anyone", "under"]
#: A sentence that holds one of these and nothing known is an unknown licence sentence.
CLAIMS = ["(?:" + "|".join(VERBS) + ") under (?:the |a |an )?(?:terms of )?(?:[a-z0-9]+ ){1,6}licen[cs]e", "spdx license identifier", "this license (?:applies|covers|grants)", "permission is hereby granted", "license agreement"]
UNKNOWN = "unknown"
#: Before a claim they deny it: the sentence speaks of a licence, but gives none.
DENIALS = "(?:not|never|no longer|neither)"

_SPACE = r"[\x20\x09-\x0D]"
_END = "\x1e"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A text becomes sentences: short forms lose their point, then sentence ends and empty lines become _END.
_SHORT = r"(?:^|[^A-Za-z0-9])((?:[vV]|[vV]er|[iI]nc|[cC]o|[nN]o|[vV]ol|e\.g|i\.e)\.)" + _SPACE
_BREAK = rf"[.!?][\"')\]]*{_SPACE}+|\n{_SPACE}*\n"


def _any_name() -> str:
    return "|".join(sorted({n for ns in NAMES.values() for n in ns}, key=lambda s: (-len(s), s)))


def _named() -> str:
    """A sentence's claim of one licence, or of several with "or" and "and" between them. A denial reads the same, with a word before."""
    verbs, the = "|".join(VERBS), "(?:the terms of )?(?:the |a |an )?"
    more = rf"(?: (?:or|and) (?:under )?{the}(?:{_any_name()}))*"
    return rf"(?:{DENIALS} )?(?:(?:{verbs}) under {the}|spdx license identifier )(?:{_any_name()}){more}"


def _pattern() -> str:
    long = sorted((p for ps in SENTENCES.values() for p in ps), key=lambda s: (-len(s), s))
    return rf"\b(?:{'|'.join(long)}|{_named()})\b"


def _trigger() -> str:
    return "(?i)" + "|".join(t.replace(" ", "[^a-z0-9]+") for t in TRIGGERS)


def _claims() -> str:
    return rf"\b(?:{'|'.join(CLAIMS)})\b"


def _known() -> dict[str, str]:
    """What the pattern finds, a sentence or a name, to its identifier."""
    return {p: i for i, ps in SENTENCES.items() for p in ps} | {n: f"named-{i}" for i, ns in NAMES.items() for n in ns}


def _rule_pattern(run: list[str]) -> str:
    """A rule as a pattern over ",<identifier>," parts."""
    part = lambda s: "(?:" + "|".join("," + i.replace(".", r"\.") + "," for i in s.rstrip("?").split("|")) + ")" + "?" * s.endswith("?")
    return "".join(map(part, run))


def sentences(text: Column) -> Column:
    """array<string>: the normalised sentences of a text, none empty."""
    split = F.split(F.regexp_replace(F.regexp_replace(text, _SHORT, " $1"), _BREAK, _END), _END)
    clean = F.transform(split, lambda s: F.trim(F.regexp_replace(F.translate(s, _UPPER, _LOWER), "[^a-z0-9]+", " ")))
    return F.filter(clean, lambda s: s != "")


def sentence_ids(text: Column) -> Column:
    """array<string>: identifiers of the licence sentences of a text, in order, repeats included."""
    known = F.create_map(*(F.lit(x) for p, i in _known().items() for x in (p, i)))
    names = lambda p: F.transform(F.regexp_extract_all(p, F.lit(rf"\b(?:{_any_name()})\b"), F.lit(0)), lambda n: known[n])
    one = lambda p: F.when(p.rlike(f"^{DENIALS} "), F.array(F.lit(UNKNOWN))).when(known[p].isNotNull(), F.array(known[p])).otherwise(names(p))
    ids = lambda s: F.flatten(F.transform(F.regexp_extract_all(s, F.lit(_pattern()), F.lit(0)), one))
    unknown = lambda s: F.when(s.rlike(_claims()), F.array(F.lit(UNKNOWN))).otherwise(F.array().cast("array<string>"))
    found = F.flatten(F.transform(sentences(text), lambda s: F.when(s.rlike(_pattern()), ids(s)).otherwise(unknown(s))))
    low = F.lower(text)
    stem = reduce(Column.__or__, (F.contains(low, F.lit(x)) for x in STEMS))
    return F.when(F.when(stem, text.rlike(_trigger())).otherwise(False), found).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column) -> Column:
    """struct(rest, found): licences of the rules that match, in rule order, and the identifiers that no rule took.

    Both are texts of ",<item>," parts, and "|" where a run was taken; the rules are tried one after the other on what the
    earlier ones left.
    """
    rules = F.array(*(F.struct(F.lit(f",{name},").alias("name"), F.lit(_rule_pattern(run)).alias("run")) for name, run in RULES))
    start = F.struct(F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit(","), i, F.lit(",")))).alias("rest"), F.lit("").alias("found"))
    taken = lambda s, r: F.struct(F.regexp_replace(s["rest"], r["run"], F.lit("|")).alias("rest"), F.concat(s["found"], r["name"]).alias("found"))
    return F.aggregate(rules, start, lambda s, r: F.when(F.regexp_like(s["rest"], r["run"]), taken(s, r)).otherwise(s))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_sentences, sentences, licenses, status.

    sentences and licenses are comma-separated, in order of the text and of the rules (each licence once). status is
    `none` without licence sentences, `known` if rules took them all, `unknown` if no sentence is a known one, else `partial`. Null and empty texts
    have none; rows that repeat are scanned each; other columns are not read; an empty table gives an empty one. A map over
    the rows: nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(text_or_empty(F.col(text_col))).alias("ids"))
    rows = rows.select("doc_id", "ids", F.when(F.size("ids") > 0, match_rules(F.col("ids"))).alias("m"))
    names = F.array_distinct(F.filter(F.split(F.coalesce("m.found", F.lit("")), ","), lambda x: x != ""))
    status = F.when(F.size("ids") == 0, "none").when(F.forall("ids", lambda i: i == UNKNOWN), "unknown").when(F.replace(F.col("m.rest"), F.lit("|"), F.lit("")) == "", "known").otherwise("partial")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentences"), F.array_join(names, ",").alias("licenses"), status.alias("status"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(p)}, '{i}')" for p, i in _known().items())
    rules = ", ".join(f"({n}, '{name}', {quoted(_rule_pattern(run))})" for n, (name, run) in enumerate(RULES))
    return rf"""
WITH RECURSIVE known(phrase, id) AS (VALUES {known}),
rules(n, name, run) AS (VALUES {rules}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT rid, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM (
    SELECT rid, string_split(regexp_replace(regexp_replace(text, {quoted(_SHORT)}, ' \1', 'g'), {quoted(_BREAK)}, chr(30), 'g'), chr(30)) AS parts
    FROM docs WHERE regexp_matches(text, {quoted(_trigger())}))),
clean AS (SELECT rid, i, trim(regexp_replace(translate(part, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS s FROM split),
phrases AS (SELECT rid, i, unnest(p) AS p, unnest(range(len(p))) AS k FROM (SELECT rid, i, regexp_extract_all(s, {quoted(_pattern())}, 0) AS p FROM clean)),
parted AS (SELECT rid, i, k, CASE WHEN regexp_matches(p, '^{DENIALS} ') THEN ['{UNKNOWN}'] WHEN p IN (SELECT phrase FROM known) THEN [p] ELSE regexp_extract_all(p, {quoted(rf"\b(?:{_any_name()})\b")}, 0) END AS ps FROM phrases),
named AS (SELECT rid, i, k * 1000 + unnest(range(len(ps))) AS k, unnest(ps) AS phrase FROM parted),
found AS (
  SELECT rid, i, k, CASE WHEN phrase = '{UNKNOWN}' THEN phrase ELSE id END AS id FROM named LEFT JOIN known USING (phrase)
  UNION ALL SELECT rid, i, 0, '{UNKNOWN}' FROM clean WHERE NOT regexp_matches(s, {quoted(_pattern())}) AND regexp_matches(s, {quoted(_claims())})),
listed AS (SELECT rid, string_agg(id, ',' ORDER BY i, k) AS sentences, string_agg(',' || id || ',', '' ORDER BY i, k) AS rest, count(*) AS n, count(*) FILTER (id <> '{UNKNOWN}') AS known FROM found GROUP BY rid),
steps AS (
  SELECT rid, 0 AS k, rest, []::VARCHAR[] AS names FROM listed
  UNION ALL
  SELECT rid, k + 1, regexp_replace(rest, run, '|', 'g'), CASE WHEN regexp_matches(rest, run) AND NOT list_contains(names, name) THEN list_append(names, name) ELSE names END
  FROM steps JOIN rules ON n = k)
SELECT doc_id, coalesce(listed.n, 0) AS n_sentences, coalesce(sentences, '') AS sentences, coalesce(array_to_string(names, ','), '') AS licenses,
       CASE WHEN listed.n IS NULL THEN 'none' WHEN listed.known = 0 THEN 'unknown' WHEN replace(steps.rest, '|', '') = '' THEN 'known' ELSE 'partial' END AS status
FROM docs LEFT JOIN listed USING (rid) LEFT JOIN steps ON steps.rid = docs.rid AND k = {len(RULES)}
"""


ORACLE = _oracle()
