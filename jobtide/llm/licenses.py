"""Licence statements: known sentences become identifiers, ordered rules read the sequence of identifiers.

Everything here is a DataFrame or SQL expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of licence notices, as they are published.
SENTENCES = {
    "mit-ref": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "apache2-ref": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "apache2-use": ["you may not use this file except in compliance with the License."],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Licensed under the GPLv3."],
    "gpl2-ref": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "lgpl-ref": ["Licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU Lesser General Public License, version 3."],
    "agpl-ref": ["Licensed under the GNU Affero General Public License, version 3.", "This work is licensed under the GNU Affero General Public License, version 3."],
    "bsd-redistribute": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "cc-by-ref": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-ref": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-ref": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0-ref": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "mpl2-ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "rights": ["All rights reserved."],
}
#: Rules in order: licence, how sure, and the identifiers that must follow one another (others may lie between).
RULES = [
    ("MIT", "full", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("BSD-3-Clause", "full", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", "full", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", "notice", ["apache2-ref", "apache2-use"]),
    ("GPL-3.0-or-later", "notice", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", "part", ["gpl-free"]),
    ("MIT", "part", ["mit-grant"]),
    ("BSD-2-Clause", "part", ["bsd-redistribute"]),
    ("MIT", "reference", ["mit-ref"]),
    ("Apache-2.0", "reference", ["apache2-ref"]),
    ("GPL-3.0-only", "reference", ["gpl3-ref"]),
    ("GPL-2.0-only", "reference", ["gpl2-ref"]),
    ("LGPL-3.0-only", "reference", ["lgpl-ref"]),
    ("AGPL-3.0-only", "reference", ["agpl-ref"]),
    ("CC-BY-4.0", "reference", ["cc-by-ref"]),
    ("CC-BY-NC-4.0", "reference", ["cc-by-nc-ref"]),
    ("CC-BY-SA-4.0", "reference", ["cc-by-sa-ref"]),
    ("CC0-1.0", "reference", ["cc0-ref"]),
    ("MPL-2.0", "reference", ["mpl2-ref"]),
    ("Proprietary", "reference", ["rights"]),
]
#: A known sentence holds at least one of these words, so texts without any are done at once.
TRIGGERS = "licen[sc]e|permission|warranty|redistribut|copyright|rights|released"
#: Cuts after a mark, at an empty line, and before a line that looks like a new sentence but may be a wrapped one.
_CUT, _EMPTY, _LINE = chr(30), chr(29), chr(31)


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier."""
    return {_plain(s): name for name, texts in SENTENCES.items() for s in texts}


def cut(text: Column) -> Column:
    """The normalised text with its cuts: after a mark and a blank, at empty lines, and before a line that starts with a capital, a digit or a bullet."""
    out = F.translate(text, _EMPTY + _LINE, "__")
    out = F.regexp_replace(out, "([.!?;:])[ \t\r\n]+", f"$1{_CUT}")
    out = F.regexp_replace(out, "\n[ \t\r]*\n[ \t\r\n]*", _EMPTY)
    out = F.regexp_replace(out, "\n([A-Z0-9(*-])", f"{_LINE}$1")
    out = F.regexp_replace(F.lower(out), f"[^a-z0-9{_EMPTY}{_CUT}{_LINE}]+", " ")
    return F.trim(F.regexp_replace(out, f" ?([{_EMPTY}{_CUT}{_LINE}]) ?", "$1"))


def _sentence_pattern(sentence: str) -> str:
    """A published sentence in a cut text: its own marks may cut it, and it may be wrapped before any word."""
    pieces = re.split("(?<=[.!?;:])[ \t\r\n]+", sentence)
    return f"[ {_CUT}{_LINE}]".join(_plain(piece).replace(" ", f"[ {_LINE}]") for piece in pieces)


def known_pattern() -> str:
    """Any known sentence between two cuts, the longest first."""
    texts = sorted((s for texts in SENTENCES.values() for s in texts), key=lambda s: -len(_plain(s)))
    return f"(?<![a-z0-9 ])(?:{'|'.join(map(_sentence_pattern, texts))})(?![a-z0-9 ])"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences): what each document's known sentences are, in order, and what they say.

    Rules are tried in order. A match takes the nearest sentences that complete it, and a sentence that a match has taken belongs to no
    later rule: the text of a longer licence does not also count as a shorter one that it holds. Needs `doc_id` and `text`; other
    columns are ignored. Null and empty texts, and texts without a known sentence, have empty lists; repeated rows are reported each;
    an empty table gives no rows.
    """
    known = known_sentences()
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    text = F.coalesce("text", F.lit(""))
    hits = F.regexp_extract_all(cut(text), F.lit(known_pattern()), F.lit(0))
    names = F.transform(hits, lambda s: F.element_at(table, F.translate(s, _CUT + _LINE, "  ")))
    ids = F.when(F.lower(text).rlike(TRIGGERS), names).otherwise(F.expr("cast(array() as array<string>)"))
    line = F.array_join(F.transform("ids", lambda s: F.concat(F.lit(","), s, F.lit(","))), "")
    rows = docs.select("doc_id", ids.alias("ids")).select("doc_id", F.array_join("ids", ",").alias("sentence_ids"), line.alias("line"), F.lit("").alias("found"))
    for name, _, sequence in RULES:
        hit = F.col("line").rlike(_pattern(sequence))
        rows = rows.select("doc_id", "sentence_ids", F.regexp_replace("line", _pattern(sequence), _others(sequence, "$")).alias("line"),
                           F.when(hit, F.concat("found", F.lit(f"{name},"))).otherwise(F.col("found")).alias("found"))
    licences = F.array_join(F.array_distinct(F.filter(F.split("found", ","), lambda x: x != "")), ",")
    return rows.select("doc_id", "sentence_ids", licences.alias("licences"))


def _pattern(sequence: list[str]) -> str:
    """The sentences of a rule, and as few others between them as can be."""
    return "((?:,[^,]+,)*?)".join(f",{name}," for name in sequence)


def _others(sequence: list[str], mark: str) -> str:
    """What stands between the sentences of a match."""
    return "".join(f"{mark}{i}" for i in range(1, len(sequence)))


def sql_twin() -> str:
    """The scan as DuckDB SQL. That dialect's patterns cannot look around, so each cut is doubled: one for either neighbour."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = known_sentences()
    texts, names = ("[" + ", ".join(map(quoted, x)) + "]" for x in (known, known.values()))
    cuts = {_CUT: "chr(30)", _EMPTY: "chr(29)", _LINE: "chr(31)"}
    sentences = sorted((s for found in SENTENCES.values() for s in found), key=lambda s: -len(_plain(s)))
    wrapped = lambda words: _plain(words).replace(" ", "(?: |\x1F\x1F)")
    spelled = "|".join("(?: |\x1E\x1E|\x1F\x1F)".join(map(wrapped, re.split("(?<=[.!?;:])[ \t\r\n]+", s))) for s in sentences)
    steps = "".join(f""",
step{i} as (select doc_id, sentence_ids, regexp_replace(line, {quoted(_pattern(sequence))}, {quoted(_others(sequence, chr(92)))}, 'g') as line,
  found || case when regexp_matches(line, {quoted(_pattern(sequence))}) then [{quoted(name)}] else [] end as found from step{i - 1})""" for i, (name, _, sequence) in enumerate(RULES, 1))
    doubled = "cut"
    for c in cuts.values():
        doubled = f"replace({doubled}, {c}, {c} || {c})"
    single = "s"
    for c in (cuts[_CUT], cuts[_LINE]):
        single = f"replace({single}, {c} || {c}, ' ')"
    return f"""
with marked as (
  select doc_id, regexp_replace(regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(29) || chr(31), '__'),
      '([.!?;:])[ \t\r\n]+', '\\1' || chr(30), 'g'), '\n[ \t\r]*\n[ \t\r\n]*', chr(29), 'g'),
      '\n([A-Z0-9(*-])', chr(31) || '\\1', 'g') as text from documents),
cuts as (
  select doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\x1D\x1E\x1F]+', ' ', 'g'), ' ?([\x1D\x1E\x1F]) ?', '\\1', 'g')) as cut from marked),
hits as (
  select doc_id, regexp_extract_all({doubled}, {quoted(f"(?:^|[\x1D\x1E\x1F])({spelled})(?:$|[\x1D\x1E\x1F])")}, 1) as found from cuts),
named as (select doc_id, list_transform(found, lambda s: list_extract({names}, list_position({texts}, {single}))) as ids from hits),
step0 as (select doc_id, coalesce(array_to_string(ids, ','), '') as sentence_ids, coalesce(array_to_string(list_transform(ids, lambda s: ',' || s || ','), ''), '') as line,
  cast([] as varchar[]) as found from named){steps}
select doc_id, sentence_ids, coalesce(array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ','), '') as licences from step{len(RULES)}"""
