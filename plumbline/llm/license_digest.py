"""Licence scan by canonical digests, in DataFrame functions only.

A whole text is normalised (case, copyright lines, punctuation, spacing, equivalent spellings), hashed, and joined
to the digests of known licences, which go through the same expressions. The known table is given with
the code and broadcast within a checked bound; texts are read once and never shuffled.

Defined cases: null and empty texts have the digest of the empty text and no licence; of known licences with one digest
the least name counts; repeated rows give equal rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import look_up
from plumbline.llm.license_texts import KNOWN

#: A line that only states a copyright: the word or sign, then a sign, a year, a placeholder or "by".
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t]+(\(c\)|©|[0-9]{4}|<year>|\[year\]|\[yyyy\]|by )|©|\(c\)[ \t]+[0-9]{4})[^\n]*$"
RESERVED_LINE = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[.!]?[ \t]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Spellings that count as equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
#: Several words that count as one or as others; after punctuation went, "sub-license" is "sub license".
PHRASES = {
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "non commercial": "noncommercial",
    "per cent": "percent",
    "sub license": "sublicense",
    "sub licensed": "sublicensed",
    "sub licenses": "sublicenses",
    "sub licensing": "sublicensing",
}


def normalised(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "\r\n?", "\n"), COPYRIGHT_LINE, " "), RESERVED_LINE, " ")
    words = F.split(F.trim(F.regexp_replace(bare, NOT_WORD, " ")), " ")
    equal = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    # Each word with spaces of its own on both sides, so that phrases that follow each other are all found.
    out = F.concat(F.lit(" "), F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(equal, w), w)), "  "), F.lit(" "))
    for phrase, one in PHRASES.items():
        out = F.replace(out, F.lit(f" {phrase.replace(' ', '  ')} "), F.lit(f" {one.replace(' ', '  ')} "))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def known_digests(spark, texts: dict[str, str] = KNOWN) -> DataFrame:
    table = spark.createDataFrame(list(texts.items()), "license string, text string")
    return table.groupBy(F.sha2(normalised(F.col("text")), 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: dict[str, str] = KNOWN) -> DataFrame:
    """One row for each document: doc_id, digest, license (null if its text is no known one)."""
    digests = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("digest"))
    return look_up(digests, known_digests(docs.sparkSession, texts), ["digest"]).select("doc_id", "digest", "license")
