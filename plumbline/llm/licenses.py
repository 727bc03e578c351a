"""Licence scans by canonical digest: texts that differ in case, punctuation, white space, title, copyright lines and equivalent spellings alone have
the same digest, and whole texts are joined by digest with those of known licences."""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that licence guidelines hold to be equivalent; the second one is canonical.
EQUIVALENT = {
    "acknowledgment": "acknowledgement", "analog": "analogue", "analyze": "analyse", "artifact": "artefact", "authorization": "authorisation",
    "authorized": "authorised", "caliber": "calibre", "canceled": "cancelled", "capitalizations": "capitalisations", "catalog": "catalogue",
    "categorize": "categorise", "center": "centre", "emphasized": "emphasised", "favor": "favour", "favorite": "favourite", "fulfill": "fulfil",
    "fulfillment": "fulfilment", "https": "http", "initialize": "initialise", "judgement": "judgment", "labeling": "labelling", "labor": "labour",
    "licence": "license", "licenced": "licensed", "licences": "licenses", "maximize": "maximise", "modeled": "modelled", "modeling": "modelling",
    "noncommercial": "non commercial", "offense": "offence", "optimize": "optimise", "organization": "organisation", "organize": "organise",
    "practice": "practise", "program": "programme", "realize": "realise", "recognize": "recognise", "signaling": "signalling", "sublicence": "sublicense",
    "utilization": "utilisation", "wilful": "willful", "c": "copyright", "version": "v",
}

#: Names and texts of short public licences and of the usual one-line notices; longer texts lie in `license_texts`.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)

#: Lines that name a holder or a year and say nothing about the terms. A wrapped line of the terms may begin with "copyright" or "(c)" as well,
#: so a sign, a year or the place of one must follow.
_YEAR = r"(\d{4}|19yy|[<\[{](yyyy|year))"
COPYRIGHT_LINE = (
    rf"(?im)^[ \t*#/;-]*(copyright[ \t:,]*(\(c\)|©|&copy;|{_YEAR})|\(c\)[ \t:,]*(copyright[ \t:,]*)?{_YEAR}|©)[^\n]*$"
    r"|^[ \t*#/;-]*all rights reserved[.!]?[ \t\r*#/;-]*$"
)

#: The title above the terms, with version, date, address and underline; a text that is nothing but a title keeps it.
TITLE = (
    r"(?i)\A[\s*#/;=-]*+(?:(?:the[ \t]+)?\"?(?:mit(?:/x11)?|expat|x11|isc|artistic|(?:(?:new|modified|simplified|revised|[23][- ]clause|two[- ]clause|three[- ]clause)[ \t]+)?bsd"
    r"|bsd[ \t]+(?:[23]|two|three)[- ]clause(?:[ \t]+\"?(?:new|simplified)\"?(?:[ \t]+or[ \t]+\"?(?:revised|freebsd)\"?)?)?"
    r"|apache(?:[ \t]+software)?|mozilla[ \t]+public|gnu[ \t]+(?:(?:lesser|library)[ \t]+)?general[ \t]+public|gnu[ \t]+free[ \t]+documentation)[ \t]+licen[cs]e\"?"
    r"|creative[ \t]+commons[ \t]+legal[ \t]+code\s+cc0[ \t]+1\.0[ \t]+universal|cc0[ \t]+1\.0[ \t]+universal)"
    r"(?:,?[ \t]+(?:v|version[ \t]*)?\d[\d.]*(?:,[ \t]+(?:\d+[ \t]+)?\p{L}+[ \t]+\d{4})?)?(?:[ \t]+\([^()\n]{1,40}\))?[ \t.:*#/;=-]*\R"
    r"(?:[\s*#/;]*+(?:version[ \t]+\d[^\n]{0,40}|<?https?://\S++|[=~_-]{3,}+)[ \t*#/;]*+\R)*+(?=\s*+\S)"  # possessive: no stack frame a line
)


def canonical(text: Column) -> Column:
    """Lower-case words, parted by one space: no title, no copyright lines, no punctuation, one spelling."""
    bare = F.when(F.regexp(text, F.lit(COPYRIGHT_LINE)), F.regexp_replace(text, COPYRIGHT_LINE, " ")).otherwise(text)
    words = F.trim(F.regexp_replace(F.lower(F.regexp_replace(bare, TITLE, " ")), r"[^\p{L}\p{N}]+", " "))
    spelled = F.create_map(*(F.lit(x) for pair in EQUIVALENT.items() for x in pair))
    some = rf"\b({'|'.join(EQUIVALENT)})\b"
    one = F.array_join(F.transform(F.split(words, " "), lambda w: F.coalesce(F.element_at(spelled, w), w)), " ")
    return F.when(F.regexp(words, F.lit(some)), one).otherwise(words)


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of licence texts (license_id, text); of several names for one text the first in order stays."""
    return known.where("text IS NOT NULL AND license_id IS NOT NULL").groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def whole_texts() -> list[tuple[str, str]]:
    """Names and texts of `license_texts` (NAME.txt or NAME_variant.txt), also without what follows the terms and with bullets for BSD's numbers."""
    found = []
    for file in sorted((f for f in files("plumbline.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt").split("_")[0], file.read_text("utf-8")
        end = re.search(r"END OF TERMS AND CONDITIONS", text)
        found += [(name, text)] + ([(name, text[: end.end()]), (name, text[: end.start()])] if end else [])
        found += [(name, re.sub(r"(?m)^\d\. ", "* ", text))] if name.startswith("BSD") else []
    return found


def built_in(spark: SparkSession) -> DataFrame:
    """The known licences (license_id, text): KNOWN, ISC also as first worded, and the whole texts."""
    older = [(n, t.replace("and/or distribute", "and distribute")) for n, t in KNOWN if n == "ISC"]
    return spark.createDataFrame([*KNOWN, *older, *whole_texts()], "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """For each row of `docs` (doc_id, text): digest of the canonical whole text, license_id if the whole text is a known licence, and
    notices, the sorted ids of the known licences that a whole line of it is.

    NULL text has no digest, no licence and no notices. A text of copyright lines and punctuation alone has the digest of empty text, which is
    no licence unless `known` holds one. Repeated rows are each answered; rows that share a doc_id share their notices, and a row without
    doc_id has none. Other columns are ignored. Texts do not travel, their digests do; `known` is broadcast by Spark only if it is small.
    """
    digests = known_digests(known)
    whole = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest")).join(digests, "digest", "left")
    lines = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", "\n", -1))).alias("line"))
    named = lines.select("doc_id", F.sha2(canonical(F.col("line")), 256).alias("digest")).join(digests, "digest")
    notices = named.groupBy(F.col("doc_id").alias("_doc")).agg(F.sort_array(F.collect_set("license_id")).alias("notices"))
    return whole.join(notices, F.col("doc_id") == F.col("_doc"), "left").select(
        "doc_id", "digest", "license_id", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
