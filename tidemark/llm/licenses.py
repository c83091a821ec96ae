"""Operator 1: licence scan by canonical digest lookup.

Texts are brought to a canonical form (ASCII case, copyright lines dropped,
equivalent spellings and version numbers, punctuation and white space to single spaces) and whole
units are joined by digest with known licences: the entire document against
licence texts, and every entire line against one-line notices.  Equal digests
mean equal canonical texts; there is no fuzzy step.

Only matching lines are grouped, so a notice found in a third of all lines costs
one small row each, combined map-side by document.

Defined cases: null or empty text has the digest of the empty text and matches
nothing; a document may carry several notices; rows that share a doc_id share
their notices; rows with a null doc_id report no notices; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, row_cols, small_side, stage
from tidemark.llm.license_texts import DIGESTS, KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spellings that count as equal, applied in this order to lower-case text.
EQUIVALENT = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("honour", "honor"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("wilful", "willful"), ("fulfil ", "fulfill "),
    ("per cent", "percent"), ("https://", "http://"), ("&", "and"),
]
#: "version 2" and "v. 2" are "v2"; "conversion 3" and "Foo v. Bar" stay.
VERSION = r"(^|[^\p{L}\p{N}])(?:version |v\. ?)([0-9])"
#: Lines that state a copyright: with a sign, a year, a placeholder or "the ... authors"; licence texts wrap at "copyright holders", so the word alone is none.
COPYRIGHT_LINE = (r"(^|\n)[^\p{L}\p{N}\n]*(?:copyright[ ]*(?:\(c\)|©|[0-9]|[\[<{])|copyright[ ]+the [^\n]*authors|copyright [^\n]*[^0-9](?:19|20)[0-9][0-9]"
                  r"|©|\(c\)[ ]*[0-9]|all rights reserved)[^\n]*")


def canonical_lines(text: Column) -> Column:
    """The canonical text, still in lines."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, VERSION, "$1v$2")
    return F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[\n ]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """digest, license_id and kind (``text`` or ``notice``) of known licences, given as texts or (whole texts) as digests; of equal digests the first id counts."""
    rows = spark.createDataFrame(known, "license_id string, kind string, text string")
    made = rows.select("license_id", "kind", F.md5(whole(canonical_lines(F.col("text")))).alias("digest"))
    long = spark.createDataFrame([(i, "text", d) for i, d in digests], "license_id string, kind string, digest string")
    return made.union(long).groupBy("digest", "kind").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license_id of the entire text, notices (sorted distinct ids) and the number of notice lines."""
    spark = docs.sparkSession
    known = small_side(known if known is not None else known_digests(spark), 256)
    canonical = row_cols(docs, "doc_id", "text").select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    lines = F.transform(F.filter(F.split("lines", "\n"), lambda x: F.length(x) > 1), lambda x: F.md5(F.trim(x)))
    # digests are written once, so a text is brought to its canonical form once
    units = stage(canonical.select("doc_id", F.md5(whole(F.col("lines"))).alias("digest"), lines.alias("line_digests")), "digests")
    notices = (units.filter(F.col("doc_id").isNotNull()).select("doc_id", F.explode("line_digests").alias("digest"))
               .join(known.filter("kind = 'notice'").select("digest", "license_id"), "digest")
               .groupBy("doc_id").agg(F.array_sort(F.collect_set("license_id")).alias("ids"), F.count("*").alias("n_notices")))
    texts = known.filter("kind = 'text'").select("digest", "license_id")
    return (units.select("doc_id", "digest").join(texts, "digest", "left")
            .join(small_side(notices, 512), "doc_id", "left")
            .select("doc_id", "digest", "license_id", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("notices"),
                    F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle() -> str:
    """The same look-up in DuckDB SQL."""
    def canon(c: str) -> str:
        t = f"regexp_replace(translate(coalesce({c}, ''), '{UPPER}', '{LOWER}'), '{COPYRIGHT_LINE}', '\\1', 'g')"
        for a, b in EQUIVALENT:
            t = f"replace({t}, {_sql_text(a)}, {_sql_text(b)})"
        t = f"regexp_replace({t}, '{VERSION}', '\\1v\\2', 'g')"
        return f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"

    flat = "trim(regexp_replace(c, '[\\n ]+', ' ', 'g'))"
    known = ", ".join(f"({_sql_text(i)}, {_sql_text(k)}, {_sql_text(t)})" for i, k, t in KNOWN)
    long = ", ".join(f"({_sql_text(i)}, 'text', '{d}')" for i, d in DIGESTS)
    return f"""
WITH k0 AS (SELECT id, kind, {canon('t')} AS c FROM (VALUES {known}) v(id, kind, t)),
k1 AS (SELECT md5({flat}) AS digest, kind, id FROM k0 UNION ALL SELECT digest, kind, id FROM (VALUES {long}) v(id, kind, digest)),
k AS (SELECT digest, kind, min(id) AS license_id FROM k1 GROUP BY ALL),
d AS (SELECT doc_id, {canon('text')} AS c FROM documents),
l AS (SELECT doc_id, unnest(string_split(c, chr(10))) AS line FROM d WHERE doc_id IS NOT NULL),
n AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT license_id)), ',') AS notices, count(*) AS n_notices
      FROM l JOIN k ON k.kind = 'notice' AND k.digest = md5(trim(line)) WHERE length(line) > 1 GROUP BY doc_id)
SELECT d.doc_id, md5({flat}) AS digest, k.license_id, coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM d LEFT JOIN k ON k.kind = 'text' AND k.digest = md5({flat}) LEFT JOIN n USING (doc_id)
"""
