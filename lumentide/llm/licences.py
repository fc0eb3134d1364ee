"""Licence texts and notices found by digests of their canonical form."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lumentide.llm.common import utf8

# --- fixed values: texts and notices of public licences ---
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
TEXTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0"),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause",),
    "BSD-3-Clause": (
        "Released under the BSD License.", "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.", "Licensed under CC BY-SA 4.0."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-only"),
    "ISC": (ISC, "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "MIT": (MIT, "Released under the MIT License.", "Licensed under the MIT License.",
            "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. "
                "2.0.", "SPDX-License-Identifier: MPL-2.0"),
}
#: Spellings that count as equal; the second is the canonical one.
EQUIVALENT: tuple[tuple[str, str], ...] = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("favour", "favor"), ("http", "https"), ("licence", "license"), ("licenced", "licensed"),
    ("licences", "licenses"), ("noncommercial", "non commercial"), ("organisation", "organization"),
    ("per cent", "percent"), ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("v2", "version 2"), ("v3", "version 3"), ("v", "version"),
)
# --- end of fixed values ---

#: Where a text's appendix begins; the licence is also known without it.
_APPENDIX = {
    "Apache-2.0": "APPENDIX: How to apply", "GFDL-1.2": "ADDENDUM: How to use",
    "GFDL-1.3": "ADDENDUM: How to use", "GPL-1.0": "Appendix: How to Apply These Terms",
    "GPL-2.0": "How to Apply These Terms", "GPL-3.0": "How to Apply These Terms",
    "LGPL-2.0": "How to Apply These Terms", "LGPL-2.1": "How to Apply These Terms",
    "MPL-1.1": "EXHIBIT A", "MPL-2.0": "Exhibit A - Source",
}


def whole_texts() -> dict[str, list[str]]:
    """The texts in the folder `licence_texts`, each with its usual variants."""
    made = {}
    for path in sorted((Path(__file__).parent / "licence_texts").iterdir()):
        text = path.read_text(encoding="utf-8")
        made[path.name] = sorted({
            text.replace("{holder}", holder).replace("{owner}", owner)
            for holder in ("the copyright holder", "the University", "the author")
            for owner in ("COPYRIGHT HOLDER", "COPYRIGHT HOLDERS", "COPYRIGHT OWNER")})
        if path.name in _APPENDIX:
            made[path.name].append(text[:text.index(_APPENDIX[path.name])])
    return made


#: ASCII letters lower-cased, digits and what lies beyond ASCII kept, the rest to spaces.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
               for c in range(256))
_COPYRIGHT = re.compile(
    rb"^\W*(?:copyright\b|\(c\)|\xc2\xa9|all rights reserved\b)", re.IGNORECASE)
_SPELLING = {a.encode(): b.encode() for a, b in EQUIVALENT}
_OTHER = re.compile(rb"(?<![^ \n])(?:" + b"|".join(
    x.replace(b" ", b"[ \n]") for x in sorted(_SPELLING, key=len, reverse=True)) + rb")(?![^ \n])")


def canonical_lines(text: bytes) -> list[bytes]:
    """The lines that hold words, with case, punctuation, white space and spellings normalised.

    Copyright lines are left out. A spelling that goes over a line's end stays in its first line.
    """
    if b"opyright" in text or b"OPYRIGHT" in text or b"(" in text or b"\xc2\xa9" in text or (
            b"ights" in text or b"IGHTS" in text):
        text = b"\n".join(x for x in text.split(b"\n") if not _COPYRIGHT.match(x))
    lines = (b" ".join(x.translate(_TABLE).split()) for x in text.split(b"\n"))
    flat = _OTHER.sub(
        lambda m: _SPELLING[m[0].replace(b"\n", b" ")], b"\n".join(x for x in lines if x))
    return flat.split(b"\n") if flat else []


def canonical(text: bytes) -> bytes:
    """The canonical lines in one."""
    return b" ".join(canonical_lines(text))


def digest(text: bytes) -> bytes:
    return hashlib.sha256(canonical(text)).digest()


def known_licences(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """`_digest`, `_words` and `license` of the known texts: those above, or of (license, text)."""
    if texts is None:
        rows = [(bytearray(digest(t.encode())), len(canonical(t.encode()).split()), name)
                for table in (TEXTS, whole_texts()) for name, own in table.items() for t in own]
        return spark.createDataFrame(
            rows, "_digest binary, _words int, license string").dropDuplicates(["_digest"])
    schema = T.StructType([
        T.StructField("_digest", T.BinaryType()), T.StructField("_words", T.IntegerType()),
        T.StructField("license", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(map(canonical, utf8(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(x).digest() for x in own], pa.binary()),
                 pa.array([len(x.split()) for x in own], pa.int32()), batch.column(0)],
                names=schema.names)

    # Of two licences with the same canonical text the first by name stands for both.
    return (
        texts.select(F.col("license").cast("string"), "text").filter("text IS NOT NULL")
        .mapInArrow(run, schema).groupBy("_digest", "_words").agg(F.min("license").alias("license")))


def license_scan(
    docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """The known licence texts that a document is, or that some of its lines are.

    One row per document: `id_col`, `license` (of the whole text, else NULL), `notices` (the
    licences of consecutive lines, however many and with whatever blank lines between them,
    sorted and distinct) and `n_notices`. Lines are hashed together where they have as many words
    as a known text. Every compared text is whole: canonical digests are hash-joined to the known
    ones, which are broadcast up to `broadcast_rows` rows (counted first) and shuffled beyond.
    Digests leave the scan, never texts; hits are brought together by document.

    Texts that are canonically empty (NULL, blank, or of copyright lines only) match
    nothing. Rows of one id are one document. A NULL id is a document like any other.
    """
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    schema = T.StructType([
        source.schema["_doc"], T.StructField("_whole", T.BooleanType()),
        T.StructField("_digest", T.BinaryType())])
    empty = hashlib.sha256(b"").digest()
    sizes = sorted(r[0] for r in known.select("_words").distinct().collect() if r[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole, digests = [], [], []
            for row, text in enumerate(utf8(batch.column(1))):
                lines = canonical_lines(text)
                ends = list(itertools.accumulate(line.count(b" ") + 1 for line in lines))
                at = {n: i + 1 for i, n in enumerate(ends)}
                own = {
                    hashlib.sha256(b" ".join(lines[i:at[start + n]])).digest()
                    for i, start in enumerate([0, *ends[:-1]] if ends else [])
                    for n in itertools.takewhile(lambda n: start + n <= ends[-1], sizes)
                    if start + n in at}
                full = hashlib.sha256(b" ".join(lines)).digest()
                rows += [row] * (len(own) + (full != empty))
                whole += [False] * len(own) + [True] * (full != empty)
                digests += [*own, full] if full != empty else own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(whole, pa.bool_()),
                 pa.array(digests, pa.binary())], names=schema.names)

    table = F.broadcast(known) if known.count() <= broadcast_rows else known
    hits = (
        source.mapInArrow(run, schema).join(table.drop("_words"), "_digest").groupBy("_doc").agg(
            F.min(F.when(F.col("_whole"), F.col("license"))).alias("license"),
            F.sort_array(F.collect_set("license")).alias("notices")))
    ids = source.select("_doc").distinct()
    return ids.join(hits, ids["_doc"].eqNullSafe(hits["_doc"]), "left").select(
        ids["_doc"].alias(id_col), "license",
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices")
    ).withColumn("n_notices", F.size("notices").cast("bigint"))
