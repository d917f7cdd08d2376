"""Licence scan by sentence rules.

A text is normalised (case, punctuation, blanks), with marks where sentences and
lines end.  A known licence sentence may run over lines, semicolons and colons,
and stands from one mark to another; it is mapped to its identifier.  A document then is a
sequence of identifiers, which ordered rules turn into licences: longer
sequences first, each match consuming its sentences, so that the clauses of a
full licence are not also read as a shorter one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import let, table

#: Names of licences in grants (normalised), by identifier.
NAMES = {
    "Apache-2.0": ["the apache license version 2 0", "apache license 2 0", "the apache 2 0 license", "apache 2 0"],
    "MIT": ["the mit license", "mit license", "an mit license", "mit"],
    "GPL-3.0-only": ["the gnu general public license version 3", "the gnu gpl version 3", "gpl v3", "gplv3", "gpl 3 0"],
    "GPL-3.0-or-later": ["the gnu general public license version 3 or later", "gpl v3 or later"],
    "GPL-2.0-only": ["the gnu general public license version 2", "the gnu gpl version 2", "gpl v2", "gplv2", "gpl 2 0"],
    "GPL-2.0-or-later": ["the gnu general public license version 2 or later", "gpl v2 or later"],
    "LGPL-2.1-only": ["the gnu lesser general public license version 2 1", "lgpl v2 1", "lgpl 2 1"],
    "LGPL-3.0-only": ["the gnu lesser general public license version 3", "lgpl v3", "lgpl 3 0"],
    "AGPL-3.0-only": ["the gnu affero general public license version 3", "agpl v3", "agpl 3 0"],
    "MPL-2.0": ["the mozilla public license version 2 0", "mpl 2 0"],
    "BSD-2-Clause": ["the bsd 2 clause license", "the simplified bsd license"],
    "BSD-3-Clause": ["the bsd 3 clause license", "the new bsd license"],
    "CC-BY-4.0": ["cc by 4 0", "a creative commons attribution 4 0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "a creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "a creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0"],
    "CC0-1.0": ["cc0 1 0", "cc0"],
}
#: How a grant begins (normalised).
GRANTS = ["licensed under", "released under", "distributed under", "available under", "this work is licensed under",
          "this file is licensed under", "this project is licensed under", "this software is released under",
          "this program is distributed under", "spdx license identifier"]
#: Sentences of full licence texts (normalised), by identifier.
SENTENCES = {
    "mit:grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit:notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "asis:software": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd:grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd:source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd:binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "isc:grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl:free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl:free2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl:hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "apache:comply": "you may not use this file except in compliance with the license",
    "bsd:endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
}
#: Ordered rules for sequences of identifiers.
RULES = [
    ("bsd:grant bsd:source bsd:binary bsd:endorse", "BSD-3-Clause"),
    ("bsd:grant bsd:source bsd:binary", "BSD-2-Clause"),
    ("mit:grant mit:notice asis:software", "MIT"),
    ("mit:grant mit:notice", "MIT"),
    ("name:Apache-2.0 apache:comply", "Apache-2.0"),
    ("gpl:free gpl:hope", "GPL-3.0-or-later"),
    ("gpl:free2 gpl:hope", "GPL-2.0-or-later"),
    ("isc:grant asis:software", "ISC"),
    ("gpl:free", "GPL-3.0-or-later"),
    ("gpl:free2", "GPL-2.0-or-later"),
    ("isc:grant", "ISC"),
    ("mit:grant", "MIT"),
]
RULES += [(f"name:{n}", n) for n in NAMES]

#: A piece of text that holds one of these and is no known sentence stands as ``unknown``.
HINT = r"(?i)licen[sc]e|copyright|permission|redistribut|warrant"
#: Every known sentence holds one of these, so texts without them are passed over.
PASS = HINT + r"|(released|distributed|available)[^a-z0-9]+under"
#: Grants as published texts write them (normalised), where that differs from grant and name.
PUBLISHED = {"licensed under the apache license version 2 0 the license": "name:Apache-2.0"}


def known() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out = {s: i for i, s in SENTENCES.items()}
    for licence, names in NAMES.items():
        out |= {f"{grant} {name}": f"name:{licence}" for grant in GRANTS for name in names}
    return out


def marked(text: Column) -> Column:
    """The normalised text between marks: H where a sentence ends, S where a line does or after a semicolon or colon."""
    text = F.regexp_replace(F.lower(text), r"[.!?](?=[\x20\x09]|\r?\n)", "H")
    text = F.regexp_replace(text, r"[;:](?=[\x20\x09])|\n", "S")
    text = F.concat(F.lit("H"), F.regexp_replace(text, r"[^a-z0-9HS]+", " "), F.lit("H"))
    return F.regexp_replace(F.regexp_replace(text, r" ?S[ S]*", "S"), r"[ S]?H[ HS]*", "H")


def _pattern() -> str:
    """Any known sentence from mark to mark, the longest first."""
    over = lambda s: s.replace(" ", "[ S]")
    longest = lambda values: "|".join(over(v) for v in sorted(values, key=lambda v: (-len(v), v)))
    names = [n for group in NAMES.values() for n in group]
    return f"(?<=[HS])(?:{longest([*SENTENCES.values(), *PUBLISHED])}|(?:{longest(GRANTS)})[ S](?:{longest(names)}))(?=[HS])"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): sentence identifiers in order and licences found.

    A sentence that hints at a licence but is not known stands as ``unknown`` in the
    sequence and breaks no rule's order only by standing between its sentences.
    Null and empty texts: empty sequences.  A licence named twice is listed once, at its first rule.
    """
    names = known() | PUBLISHED
    table_ = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    text, pattern = F.coalesce(F.col("text"), F.lit("")), _pattern()
    unknown = lambda part: F.transform(F.filter(F.split(part, "[HS]"), lambda s: s.rlike(HINT)), lambda s: F.lit("unknown"))
    name = lambda sentence: F.array(F.try_element_at(table_, F.translate(sentence, "S", " ")))
    # what stands between the known sentences, and these themselves, in turn
    ids = let(marked(text), lambda t: let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda hits: F.flatten(F.transform(
        F.split(t, pattern), lambda part, i: F.concat(unknown(part), F.when(i < F.size(hits), name(F.get(hits, i))).otherwise(F.array().cast("array<string>")))))))
    rules = F.array(*[F.struct(F.lit(f" {seq} ").alias("seq"), F.lit(name).alias("name")) for seq, name in RULES])

    def licences(seq: Column) -> Column:
        start = F.struct(seq.alias("seq"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(rules, start, lambda acc, r: F.when(
            F.contains(acc["seq"], r["seq"]),
            F.struct(F.replace(acc["seq"], r["seq"], F.lit(" ")).alias("seq"), F.concat(acc["out"], F.array(r["name"])).alias("out"))
        ).otherwise(acc))["out"]

    none = F.array().cast("array<string>")
    found = F.when(F.lower(text).rlike(PASS), ids).otherwise(none)
    # identifiers stand between double blanks, so neighbours can match one after the other
    return docs.select("doc_id", let(found, lambda x: F.struct(
        x.alias("ids"), F.when(F.size(x) == 0, none).otherwise(licences(F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" ")))).alias("licences"))).alias("r")
    ).select("doc_id", F.col("r.ids").alias("ids"), F.array_distinct("r.licences").alias("licences"))


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"),
                       F.array_join("licences", ",").alias("licences"))


def _sql() -> str:
    esc = lambda s: s.replace("'", "''")
    names = ", ".join(f"('{esc(s)}', '{esc(i)}')" for s, i in known().items())
    rules = ", ".join(f"({n}, ' {esc(seq)} ', '{esc(name)}')" for n, (seq, name) in enumerate(RULES))
    return rf"""
WITH RECURSIVE names(s, id) AS (VALUES {names}), rules(n, seq, name) AS (VALUES {rules}),
d AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?;:])[\x20\x09]+', '\1' || chr(10), 'g'), chr(10)) AS ss FROM documents),
f AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM d),
h AS (SELECT doc_id, i, coalesce(id, 'unknown') AS id FROM (
        SELECT doc_id, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') AS s FROM f
        WHERE regexp_matches(s, '([Ll][Ii][Cc][Ee][Nn][SsCc][Ee])|([Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt])|([Pp][Ee][Rr][Mm][Ii][Ss][Ss][Ii][Oo][Nn])|([Rr][Ee][Dd][Ii][Ss][Tt][Rr][Ii][Bb][Uu][Tt])|([Ww][Aa][Rr][Rr][Aa][Nn][Tt])')) LEFT JOIN names USING (s)),
q AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY i) AS ids, ' ' || string_agg(id, ' ' ORDER BY i) || ' ' AS seq FROM h GROUP BY doc_id),
w(doc_id, n, seq, found) AS (
  SELECT doc_id, 0, seq, '' FROM q
  UNION ALL
  SELECT w.doc_id, w.n + 1, replace(w.seq, r.seq, ' '), CASE WHEN contains(w.seq, r.seq) AND NOT contains(w.found || ',', ',' || r.name || ',')
         THEN w.found || ',' || r.name ELSE w.found END FROM w JOIN rules r ON r.n = w.n),
e AS (SELECT doc_id, substr(found, 2) AS licences FROM w WHERE n = {len(RULES)})
SELECT documents.doc_id, coalesce(q.n, 0)::BIGINT AS n_sentences, coalesce(q.ids, '') AS sentence_ids, coalesce(e.licences, '') AS licences
FROM documents LEFT JOIN q USING (doc_id) LEFT JOIN e USING (doc_id)
"""


SQL_LICENCES = _sql()
