"""Licence scan: canonical digests of entire texts, and of their lines and paragraphs, joined to known ones.

A text's canonical form has lower case, no copyright lines, one spelling of
equivalent words, and single blanks in place of everything that is no letter
or digit. Its SHA-256 is joined to the digests of the known licences: an equi-join
whose small side has one row a digest, so copies of one licence need no shuffle
while the known digests fit a checked broadcast. Notices and parts of licences
inside longer texts are found by the same join over the digests of lines and
paragraphs, of which only those with a word of all known ones are digested.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BROADCAST_BYTES, read, written
from courtside.sources.fixture import inline_rows

# Pairs of spellings that licence matching treats as equal.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("non-commercial", "noncommercial"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sub-license", "sublicense"), ("sub license", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("https://", "http://"),
]

# Texts of known licences and licence notices.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE.")
KNOWN = {
    "MIT": "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of "
           'this software and associated documentation files (the "Software"), to deal in the Software '
           "without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
           "whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
           "copyright notice and this permission notice shall be included in all copies or substantial "
           "portions of the Software.\n\n" + _WARRANTY,
    "ISC": "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose "
           "with or without fee is hereby granted, provided that the above copyright notice and this "
           "permission notice appear in all copies.\n\n" + _ISC_WARRANTY,
    "0BSD": "BSD Zero Clause License\n\nPermission to use, copy, modify, and/or distribute this software for "
            "any purpose with or without fee is hereby granted.\n\n" + _ISC_WARRANTY,
}
#: Further texts, a file each: those of a Debian system's common licences, and BSD ones of installed packages.
TEXTS_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")

# Fixed value: what a notice says (in canonical form) before a licence's name.
NOTICE = ("^(?:(?:this|the) (?:work|software|project|program|code|file|document|text|content|library|package) is )?"
          "(?:(?:dual )?licensed|released|distributed|published|(?:made )?available) under (?:the terms of )?(?:(?:the|a|an) )?"
          "|^(?:spdx )?license(?: identifier)? ")


def _names() -> dict[str, list[str]]:
    """The names of licences in notices, by identifier."""
    names = {
        "MIT": ["MIT License", "MIT", "MIT/X11 License", "Expat License"],
        "ISC": ["ISC License", "ISC"], "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD"],
        "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause",
                         'BSD 2-Clause "Simplified" License'],
        "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License",
                         "BSD-3-Clause", 'BSD 3-Clause "New" or "Revised" License'],
        "Unlicense": ["Unlicense"], "Zlib": ["zlib License", "Zlib"],
        "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"],
        "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "EPL-2.0"],
        "Artistic-2.0": ["Artistic License 2.0", "Artistic-2.0"],
        "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons CC0 1.0",
                    "Creative Commons Zero v1.0 Universal", "CC0-1.0"],
    }
    for i, name, versions in (("Apache", "Apache License", ("1.1", "2.0")),
                              ("MPL", "Mozilla Public License", ("1.1", "2.0"))):
        for v in versions:
            names[f"{i}-{v}"] = [f"{name}, Version {v}", f"{name} {v}", f"{name} v{v}", f"{i}-{v}", f"{i} {v} License",
                                 f"{i} License, Version {v}", f"{i} License {v}"]
    for i, name, versions in (("GPL", "General Public License", ("1", "2", "3")),
                              ("LGPL", "Lesser General Public License", ("2.1", "3")),
                              ("LGPL", "Library General Public License", ("2",)),
                              ("AGPL", "Affero General Public License", ("3",)),
                              ("GFDL", "Free Documentation License", ("1.1", "1.2", "1.3"))):
        for v in versions:
            full = v if "." in v else f"{v}.0"
            plain = [f"GNU {name}{how}{n}" for how in (", version ", " v", " ") for n in dict.fromkeys((v, full))]
            plain += [f"{gnu}{i}{how}{n}" for gnu in ("", "GNU ") for how in ("v", " v", " ", " version ")
                      for n in dict.fromkeys((v, full))]
            names[f"{i}-{full}"] = [*plain, *[f"{x} only" for x in plain]]
            names[f"{i}-{full}-or-later"] = [f"{x}{more}" for x in plain for more in (
                " or later", " or any later version", " or (at your option) any later version")]
    for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                       ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            names[f"CC-{kind}-{v}"] = [
                f"{x}{y}" for x in (f"CC {kind} {v}", f"Creative Commons {kind} {v}", f"Creative Commons {name} {v}")
                for y in ("", " License", " International", " International License", " Unported", " Unported License",
                          " Generic", " Generic License")]
    return names


#: Starts of words of which each notice and each part of a licence looked for has one; `licens` is for both spellings.
ANCHORS = ("licens", "released", "distribut", "available", "published", "permission")
#: A paragraph of a licence of so many characters (canonical) tells it, if no other known licence has it.
PART_CHARS = 60

# Fixed value: words after `copyright` where a line of a licence's own text begins with it, not a name.
_NO_NAME = ("notices?|holders?|owners?|ownership|licen[sc]\\w*|and|or|disclaimers?|interests?|laws?|on|in|treat\\w+|"
            "statements?|permissions?|of|if|is|are|was|as|to|for|at|that|which|with|doctrines?|protect\\w+|claims?|acts?|"
            "rights?|infring\\w+|status|terms|information|file|the\\s+(?:software|library|program|work|package)")
#: Lines that name who holds the copyright: `copyright` before a sign, a year or a name, a bare (c) before a year only.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}©\n]*(?:(?:portions\s+)?copyright(?:[ \t]*[:,]?[ \t]*(?:\(c\)|©|[<\[{]|\d{4})"
    r"|[ \t]*:?[ \t]+(?!(?:" + _NO_NAME + r")\b)[\p{L}\p{N}])"
    r"|\(c\)[ \t]*(?:copyright[ \t]*)?\d{4}|©|all rights reserved)[^\n]*$")


def canonical(text: Column) -> Column:
    """The canonical form of a text (empty for null)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, COPYRIGHT_LINE, " ")
    spelled = F.regexp_replace(t, r"\s+", " ")
    for variant, usual in SPELLINGS:
        spelled = F.replace(spelled, F.lit(variant), F.lit(usual))
    some = "|".join(sorted({v.replace(" ", r"\s+") for v, _ in SPELLINGS}))
    t = F.when(t.rlike(some), spelled).otherwise(t)  # few texts have a variant
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def known_texts() -> dict[str, list[str]]:
    """The known licences, as they are and without a title."""
    texts = dict(KNOWN)
    for name in sorted(os.listdir(TEXTS_DIR)):
        with open(os.path.join(TEXTS_DIR, name), encoding="utf-8") as f:
            texts[name.removesuffix(".txt")] = f.read()
    found = {}
    for name, text in texts.items():
        title, _, rest = text.partition("\n\n")
        found[name] = [text, rest] if rest and len(title) < PART_CHARS and title.endswith("License") else [text]
    return found


def known_licences(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """licence, text: whole licences, and a notice for each name (as notice:<licence>)."""
    whole = [(name, text) for name, several in (texts or known_texts()).items() for text in several]
    names = "\n".join(f"notice:{name}\tLicensed under {title}" for name, titles in _names().items() for title in titles)
    notices = (spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit(names), "\n")).alias("n"))
               .select(F.split("n", "\t").alias("n")).select(F.col("n")[0].alias("licence"), F.col("n")[1].alias("text")))
    return inline_rows(spark, whole, ["licence", "text"]).unionByName(notices)


def part_digest(c: Column) -> Column:
    """The digest of a line's or paragraph's canonical form: notices of one name are equal."""
    return F.sha2(F.regexp_replace(c, NOTICE, "notice: "), 256)


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text: what stands between lines without a letter or digit."""
    return F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"\n(?:[^\p{L}\p{N}\n]*\n)+")


def known_parts(known: DataFrame) -> DataFrame:
    """part_sha256, name, anchored: digests of what is looked for in lines and paragraphs.

    Texts of one paragraph under their own name, and of longer ones (as
    part:<licence>) each paragraph that has an anchor and is no other licence's.
    """
    anchored = F.lit(False)
    for a in ANCHORS:
        anchored = anchored | F.col("c").contains(a)
    split = known.select("licence", paragraphs(F.col("text")).alias("p"))
    own = split.where(F.size("p") == 1).select("licence", canonical(F.col("p")[0]).alias("c"))
    parts = (split.where(F.size("p") > 1).select("licence", F.explode("p").alias("p"))
             .select("licence", canonical(F.col("p")).alias("c")).where(anchored & (F.length("c") >= PART_CHARS))
             .groupBy("c").agg(F.min("licence").alias("licence"), F.max("licence").alias("last"))
             .where(F.col("licence") == F.col("last"))
             .select(F.concat(F.lit("part:"), F.col("licence")).alias("licence"), "c"))
    return (own.unionByName(parts).where("c <> ''").groupBy(part_digest(F.col("c")).alias("part_sha256"))
            .agg(F.min("licence").alias("name"), F.min(anchored).alias("anchored")))


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for a broadcast if it fits one."""
    size = df.count() * 200  # digests of 64 characters, short names
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def notices_within(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text_sha256, notices for each different text with a known line or paragraph."""
    parts = written(known_parts(known), "licence-parts")
    every = parts.agg(F.min("anchored")).first()[0]  # null for an empty table
    hit = F.lower("text").rlike("|".join(ANCHORS).replace("licens", "licen[sc]")) if every else F.lit(True)
    texts = docs.select(F.col("text")).where(hit) if every is not None else docs.select("text").where("1 = 0")
    unit = texts.select(F.sha2("text", 256).alias("text_sha256"), F.explode(F.array_distinct(F.concat(
        F.split("text", r"\r\n?|\n"), paragraphs(F.col("text"))))).alias("text")).where(hit)
    return (unit.select("text_sha256", part_digest(canonical(F.col("text"))).alias("part_sha256"))
            .join(_small(parts.select("part_sha256", "name")), "part_sha256")
            .groupBy("text_sha256").agg(F.sort_array(F.collect_set("name")).alias("notices")))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, licence (null if none is known), notices.

    ``licence`` is of the entire text; ``notices`` names what is known of the
    text's lines and paragraphs (sorted, empty if there is none).

    Defined cases: a null, empty or punctuation-only text has an empty
    canonical form and no licence; of known licences with one canonical form
    the smallest name is given; repeated rows get equal rows; an empty table of
    documents gives no rows, of licences no licence. Other columns are not read.
    """
    digests = _small(written(
        known.select(canonical(F.col("text")).alias("c"), "licence").where("c <> ''")
        .groupBy(F.sha2("c", 256).alias("canonical_sha256"))
        .agg(F.min("licence").alias("licence")), "licence-digests"))
    within = _small(written(notices_within(docs, known), "licence-notices"))
    rows = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return (rows.join(digests, "canonical_sha256", "left").join(within, "text_sha256", "left")
            .select("doc_id", "canonical_sha256", "licence",
                    F.coalesce("notices", F.array().cast("array<string>")).alias("notices")))


def op7_licence_scan(spark, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"), known_licences(spark))
