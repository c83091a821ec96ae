"""Operator 2: benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after a number, and names (capitalised
words inside a sentence, and those that open one but are no word that commonly does) are typed
placeholders, other words are lower case and bare of punctuation.  A second form replaces numbers only, so that texts in another case still
meet.  Five-word template windows are joined by hash with the windows of the
benchmark.  Matched windows that follow each other at one shift of a document against an
item are a run; every value of the item must be one value of the document throughout the run
(the same name or number again wherever the item repeats it).  Runs whose values agree are
joined over shifts that differ by at most the item's number of words (so that as many words may
be put in or left out), and an item is found where they cover at least 0.8 of its words.
Windows with fewer than ``LITERALS`` literal words meet only where their words and numbers are the same ones.
Items of fewer than five words are found where all their words and signs stand in a row.

Only documents that hold the longest three literal words in a row of some benchmark window
(three words or numbers in a row where a window has too few literal words; shorter runs where an
item may be found by windows without three) reach the window step; any finding must hold such
words, so nothing is lost.  All row work is
DataFrame functions.  The benchmark's windows are broadcast only when counted to fit.

Defined cases: null or empty texts and texts without words match nothing; an item of one
word matches only a document that is nothing else; rows with a null id are matched like others; rows that
share a doc_id are told apart by their text; items without an id are left out; equal items are all reported; an empty table on either side
gives no findings; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_key, drop_rows, read, row_cols, small_side, stage, with_key

WINDOW, COVER = 5, 0.8
PAIRS = "array<struct<kind:string,item:string,doc:string>>"
#: Words of a window that must not be placeholders; windows with fewer are looked up with their values.
LITERALS = 2
PLAIN, TYPED, EXACT = 0, 1, 2
MARK = "\x01"
NUM, NAME, UNIT = "#", "@", "%"
WORD = r"[\p{L}][\p{L}\p{M}]*(?:['’][\p{L}]+)*"
NUMBER = r"[\p{N}]+(?:[.,][\p{N}]+)*"
TOKEN = f"{MARK}?{WORD}|{NUMBER}"
#: Words, numbers and single other signs.
SIGN = f"{WORD}|{NUMBER}|[^\\s]"
#: Words that are a unit where they follow a number.
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles", "meter", "meters", "metre", "metres",
         "kilometer", "kilometers", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "lb", "lbs", "ounce", "ounces", "oz",
         "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents", "euro", "euros", "percent",
         "degree", "degrees", "mph", "kmh", "w", "kw", "v", "hz", "j", "kj", "n", "pa"]

#: Words that open a sentence without being a name.
OPENERS = ["a", "after", "all", "although", "an", "and", "another", "answer", "any", "are", "as", "assume", "at", "because", "before", "between",
           "both", "but", "by", "calculate", "can", "choose", "compute", "consider", "could", "describe", "determine", "did", "do", "does", "during",
           "each", "either", "estimate", "every", "evaluate", "explain", "express", "find", "first", "for", "from", "given", "had", "has", "have", "he",
           "her", "here", "his", "how", "i", "if", "in", "into", "is", "it", "its", "later", "let", "list", "many", "more", "most", "my", "name", "neither",
           "next", "no", "not", "note", "now", "of", "on", "once", "one", "only", "or", "other", "our", "round", "second", "select", "she", "should", "show",
           "since", "simplify", "so", "solve", "some", "state", "suppose", "that", "the", "their", "then", "there", "these", "they", "this", "those", "to",
           "today", "together", "tomorrow", "two", "under", "until", "use", "using", "was", "we", "were", "what", "when", "where", "which", "while", "who",
           "whose", "why", "will", "with", "would", "write", "yesterday", "you", "your"]


def parts(pattern: str) -> Column:
    """The matches in ``text`` in lower case."""
    return F.regexp_extract_all(F.lower(F.translate("text", MARK, "")), F.lit(f"({pattern})"), F.lit(1))


def tokens(df: DataFrame) -> DataFrame:
    """Adds ``bare`` (words and numbers of ``text`` in lower case); rows with fewer than a window of them have no windows.

    They are not filtered out here: the filter would be put before the joins that leave few texts, and take all texts apart."""
    return df.withColumn("bare", parts(f"{WORD}|{NUMBER}"))


def is_number(token: Column) -> Column:
    return token.rlike(r"^\p{N}")


def forms(df: DataFrame) -> DataFrame:
    """Adds ``plain`` (numbers typed) and ``typed`` (names and units too) to ``tokens``."""
    marked = F.regexp_replace(F.translate("text", MARK, ""), r"([\p{Ll},;] )([\p{Lu}])", f"$1{MARK}$2")
    df = df.withColumn("marked", F.regexp_extract_all(marked, F.lit(f"({TOKEN})"), F.lit(1)))
    df = df.withColumn("plain", F.transform("bare", lambda w: F.when(is_number(w), NUM).otherwise(w)))
    unit = lambda w, i: (i > 0) & (F.element_at("plain", F.greatest(i, F.lit(1))) == NUM) & w.isin(UNITS)
    # lower case may change the number of words in rare scripts; then no names are told apart
    opens = lambda w, i: (F.get("marked", i) != w) & F.get("marked", i).rlike(r"^\p{Lu}[\p{Ll}\p{M}]") & ~w.isin(OPENERS)
    name = lambda w, i: (F.size("marked") == F.size("bare")) & (F.get("marked", i).startswith(MARK) | opens(w, i))
    return df.withColumn("typed", F.transform("plain", lambda w, i: F.when(unit(w, i), UNIT).when(name(w, i), NAME).otherwise(w))).drop("marked")


def tail(a: str, k: int) -> Column:
    return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))


def head(a: str, k: int) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - k, F.lit(0)))


def hashed(df: DataFrame, words: str, n: int, name: str) -> DataFrame:
    """Adds the hashes of the ``n``-word windows (2, 3 or 5) of an array, in order."""
    pair = lambda x, y: F.xxhash64(x, y)
    df = df.withColumn("h2", F.zip_with(head(words, 1), tail(words, 1), pair))
    if n == 2:
        return df.withColumnRenamed("h2", name)
    if n == 3:
        return df.withColumn(name, F.zip_with(head("h2", 1), tail(words, 2), pair)).drop("h2")
    return df.withColumn("h4", F.zip_with(head("h2", 2), tail("h2", 2), pair)).withColumn(name, F.zip_with(head("h4", 1), tail(words, 4), pair)).drop("h2", "h4")


def windows(df: DataFrame) -> DataFrame:
    """Adds the window hashes of both forms and of the words as they are: ``plain5``, ``typed5`` and ``bare5``."""
    return hashed(hashed(hashed(forms(df), "plain", WINDOW, "plain5"), "typed", WINDOW, "typed5"), "bare", WINDOW, "bare5")


def literal(word: Column) -> Column:
    return ~word.isin(NUM, NAME, UNIT)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_n, text, form, via, hash, at, ours, template) of the items' windows; ``text`` tells texts of one id apart, ``via`` is the form that the hash is of."""
    df = windows(tokens(row_cols(benchmark, "item_id", "text").filter(F.col("item_id").isNotNull())))
    one = lambda form, k: F.transform(f"{form}5", lambda h, i: F.struct(
        F.lit(k).alias("form"), h.alias("hash"), F.get("bare5", i).alias("same"), i.alias("at"),
        F.slice("bare", i + 1, WINDOW).alias("ours"), F.slice(form, i + 1, WINDOW).alias("template")))
    rows = df.select("item_id", F.size("bare").alias("item_n"), F.xxhash64("bare").alias("text"),
                     F.explode(F.concat(one("plain", PLAIN), one("typed", TYPED))).alias("w")).select("item_id", "item_n", "text", "w.*")
    enough = F.size(F.filter("template", literal)) >= LITERALS
    return (rows.withColumn("via", F.when(enough, F.col("form")).otherwise(EXACT))
            .withColumn("hash", F.when(enough, F.col("hash")).otherwise(F.col("same"))).drop("same"))


def anchors(items: DataFrame, cover: float = COVER) -> DataFrame:
    """(n, h): what a document must hold to share a window: of every window its longest run of
    three literal words, else of two, else its longest literal word; where values are looked up, its longest three words.

    Of an item's windows those with the shortest runs are left out as long as they alone cover
    less of it than a finding does: every finding then has a window that is not left out.
    """
    rows = items.select("item_id", "item_n", "form", "text", "at", F.when(F.col("via") == EXACT, F.col("ours")).otherwise(F.col("template")).alias("template"),
                        (F.col("via") == EXACT).alias("same"))
    for n in (1, 2, 3):
        runs = F.transform(F.sequence(F.lit(1), F.lit(WINDOW + 1 - n)), lambda i: F.slice("template", i, n))  # noqa: B023
        runs = F.filter(runs, lambda r: F.col("same") | F.forall(r, literal))
        longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(F.array_join(r, "")).alias("n"), r.alias("r"))))["r"]
        rows = rows.withColumn(f"r{n}", longest)
    item = ["item_id", "form", "text"]
    rows = rows.withColumn("r", F.coalesce("r3", "r2", "r1")).withColumn("n", F.size("r"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*item).orderBy("n", F.length(F.array_join("r", "")), "at")))
    # the first windows by rank cover a word from that word's least rank on; a finding covers ``least`` words
    words = rows.select(*item, "item_n", "rank", F.explode(F.sequence("at", F.col("at") + WINDOW - 1)).alias("place")).groupBy(*item, "place").agg(
        F.min("rank").alias("rank"), F.first("item_n").alias("item_n"))
    least = F.ceil(cover * F.first("item_n") - 1e-6).cast("int")
    kept = words.groupBy(*item).agg(F.try_element_at(F.array_sort(F.collect_list("rank")), F.greatest(least, F.lit(1))).alias("first"))
    rows = rows.join(kept, item).filter(F.col("rank") >= F.coalesce("first", F.lit(0)))
    r = F.col("r")
    h = F.when(F.size(r) == 1, gram(r, 1)).when(F.size(r) == 2, gram(r, 2)).otherwise(gram(r, 3))
    return rows.select("n", h.alias("h")).distinct()


def gram(words: Column, n: int, at: Column | None = None) -> Column:
    """Hash of the ``n`` words from place ``at`` on."""
    return F.xxhash64(*[F.get(words, F.lit(k) if at is None else at + k) for k in range(n)])


def short_findings(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc_id, item_id) of items shorter than a window, by all their words and signs in a row; None without such items."""
    words = F.size(parts(f"{WORD}|{NUMBER}"))
    items = row_cols(benchmark, "item_id", "text").filter(F.col("item_id").isNotNull() & (words > 0) & (words < WINDOW))
    items = stage(items.select("item_id", (words == 1).alias("alone"), parts(SIGN).alias("s")).select("item_id", "alone", F.size("s").alias("n"), F.xxhash64("s").alias("h")), "short")
    lengths = [tuple(r) for r in items.select("alone", "n").distinct().collect()]  # as many as there are lengths of short items
    if not lengths:
        return None
    hashes = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("s") - n + 1), lambda i: F.xxhash64(F.slice("s", i, n))))
    run = lambda n: F.transform(hashes(n), lambda h: F.struct(F.lit(False).alias("alone"), F.lit(n).alias("n"), h.alias("h")))
    all_of = F.array(F.struct(F.lit(True).alias("alone"), F.size("s").alias("n"), F.xxhash64("s").alias("h")))
    none = F.filter(all_of, lambda x: F.lit(False))
    grams = F.concat(all_of, *[F.when(F.size("s") >= n, run(n)).otherwise(none) for alone, n in sorted(lengths) if not alone])
    held = docs.filter(F.col("text").isNotNull()).select("doc_id", parts(SIGN).alias("s")).select("doc_id", F.explode(grams).alias("g")).select("doc_id", "g.*")
    size = items.count() * 48
    return held.join(F.broadcast(items) if size <= 8 << 20 else items, ["alone", "n", "h"]).select("doc_id", "item_id")


def candidates(docs: DataFrame, items: DataFrame, cover: float = COVER) -> DataFrame:
    """Ids of the documents that hold an anchor; texts are taken apart once for anchors of all lengths."""
    need = stage(anchors(items, cover), "anchors")
    lengths = sorted(r["n"] for r in need.select("n").distinct().collect())  # at most three numbers
    if not lengths:
        return stage(docs.select("doc_id").limit(0), "near")
    # every place of a text with the hashes that begin there: plain expressions over exploded places, no functions over arrays
    places = tokens(docs).select("doc_id", "bare", F.explode(F.when(F.size("bare") > 0, F.sequence(F.lit(0), F.size("bare") - 1))).alias("at"))
    held = F.array(*[gram(F.col("bare"), n, F.col("at")) for n in lengths])
    grams = places.select("doc_id", F.explode(held).alias("h")) if len(lengths) > 1 else places.select("doc_id", held[0].alias("h"))
    return stage(grams.join(small_side(need.select("h").distinct(), 16), "h", "left_semi").select("doc_id").distinct(), "near")


def agree(a: Column, b: Column) -> Column:
    """No value of the item is one value of the document in ``a`` and another one in ``b``."""
    return ~F.exists(a, lambda x: F.exists(b, lambda y: (x["kind"] == y["kind"]) & (x["item"] == y["item"]) & (x["doc"] != y["doc"])))


def runs(met: DataFrame) -> DataFrame:
    """Windows of one shift that follow each other, as ``run``: their number, shift, first and last place in the item,
    and slots; runs in which a value of the item is two values of the document are left out."""
    one = met.groupBy("doc_id", "row", "item_id", "form", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.first("item_n").alias("item_n"), F.array_sort(F.collect_set(F.struct("at", "pairs"))).alias("w"))
    at = lambda i: F.get("w", i)["at"]
    places = F.sequence(F.lit(0), F.size("w") - 1)
    first = F.filter(places, lambda i: (i == 0) | (at(i) != at(i - 1) + 1))
    last = F.filter(places, lambda i: (i == F.size("w") - 1) | (at(i) != at(i + 1) - 1))
    slots = lambda a, b: F.array_distinct(F.flatten(F.transform(F.slice("w", a + 1, b - a + 1), lambda x: x["pairs"])))
    found = F.zip_with(first, last, lambda a, b: F.struct((b - a + 1).alias("n"), F.col("shift"), at(a).alias("a"), at(b).alias("b"), slots(a, b).alias("pairs")))
    return one.withColumn("run", F.explode(found)).drop("w").filter(
        F.size("run.pairs") == F.size(F.array_distinct(F.transform("run.pairs", lambda x: F.struct(x["kind"], x["item"])))))


def joined_words(all_runs: Column) -> Column:
    """The most words of the item that runs of agreeing values cover, the runs of any one shift taken first and long ones before short ones."""
    longest = F.sort_array(all_runs, asc=False)

    def cover(shift: Column) -> Column:
        order = F.concat(F.filter(longest, lambda r: r["shift"] == shift), F.filter(longest, lambda r: r["shift"] != shift))
        none = F.struct(F.array().cast("array<int>").alias("at"), F.array().cast(PAIRS).alias("pairs"))
        add = lambda acc, r: F.when(agree(acc["pairs"], r["pairs"]), F.struct(
            F.array_union(acc["at"], F.sequence(r["a"], r["b"] + WINDOW - 1)).alias("at"), F.array_union(acc["pairs"], r["pairs"]).alias("pairs"))).otherwise(acc)
        return F.aggregate(order, none, add, lambda acc: F.size(acc["at"]))

    return F.array_max(F.transform(F.array_distinct(F.transform(all_runs, lambda r: r["shift"])), cover))


def slot_pairs(template: Column, ours: Column, theirs: Column) -> Column:
    """(kind, item's value, document's value) of the window's placeholders."""
    rows = F.zip_with(F.zip_with(template, ours, lambda t, a: F.struct(t.alias("kind"), a.alias("item"))), theirs,
                      lambda x, b: F.struct(x["kind"].alias("kind"), x["item"].alias("item"), b.alias("doc")))
    return F.filter(rows, lambda x: x["kind"].isin(NUM, NAME, UNIT))


def findings(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """(doc_id, item_id, covered share) of every item found in a document."""
    items = stage(item_windows(benchmark), "items")
    docs = row_cols(docs, "doc_id", "text").filter(F.col("doc_id").isNotNull()).withColumn("row", F.xxhash64("text"))  # ids may repeat
    short = short_findings(docs, benchmark)
    near = candidates(docs, items, cover)
    docs = docs.join(F.broadcast(near) if near.count() * 48 <= 8 << 20 else near, "doc_id", "left_semi")
    one = lambda form, k: F.transform(f"{form}5", lambda h, i: F.struct(F.lit(k).alias("via"), h.alias("hash"), i.alias("pos")))
    facts = items.agg(F.sum(200 + 4 * F.length(F.array_join("ours", " "))).alias("n"), F.max("via").alias("via")).first()
    size, hashes = facts["n"] or 0, [("plain", PLAIN), ("typed", TYPED), ("bare", EXACT)][: 3 if facts["via"] == EXACT else 2]
    there = windows(tokens(docs)).select("doc_id", "row", F.explode(F.concat(*[one(*x) for x in hashes])).alias("w")).select("doc_id", "row", "w.*")
    known = items.drop("text")
    met = stage(there.join(F.broadcast(known) if size <= 16 << 20 else known, ["via", "hash"]).drop("hash", "via"), "met")
    # whatever the slots say, an item is found only where its windows that were met cover enough of it
    pair = ["doc_id", "row", "item_id", "form"]
    met_words = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set("at"), lambda a: F.sequence(a, a + WINDOW - 1)))))
    enough = met.groupBy(*pair).agg((met_words / F.min("item_n")).alias("most")).filter(F.col("most") >= cover).select(*pair)
    met = stage(met.join(small_side(enough, 96), pair, "left_semi"), "covered")
    # the words of these documents are looked up again where a window has slots
    slots = F.exists("template", lambda w: ~literal(w))
    free = met.filter(~slots).withColumn("pairs", F.array().cast(PAIRS))
    bound = met.filter(slots)
    said = tokens(docs.join(small_side(bound.select("doc_id").distinct(), 48), "doc_id", "left_semi")).select("doc_id", "row", "bare").dropDuplicates(["doc_id", "row"])
    bound = bound.join(said, ["doc_id", "row"]).withColumn("pairs", slot_pairs(F.col("template"), F.col("ours"), F.slice("bare", F.col("pos") + 1, WINDOW))).drop("bare")
    # shifts that differ by at most the item's length are together in one of two overlapping rows of intervals
    groups = F.array(*[F.struct(F.lit(k).alias("k"), F.floor((F.col("shift") + k * F.col("item_n")) / (2 * F.col("item_n"))).alias("d")) for k in (0, 1)])
    lined = runs(free.unionByName(bound)).withColumn("near", F.explode(groups)).groupBy("doc_id", "row", "item_id", "form", "near").agg(
        F.first("item_n").alias("item_n"), F.collect_set("run").alias("runs"))
    found = lined.withColumn("share", joined_words(F.col("runs")) / F.col("item_n")).filter(F.col("share") >= cover).select("doc_id", "item_id", "share")
    if short is not None:
        found = found.unionByName(short.withColumn("share", F.lit(1.0)))
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """Every document with the items found in it; rows equal in id and text are one to the search."""
    same = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))
    rows = row_cols(docs, "doc_id", "text").withColumn("same", same)
    found = (findings(by_key(rows, "same"), benchmark, cover).groupBy(F.col("doc_id").alias("same"))
             .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share")))
    return (rows.select("doc_id", "same").join(small_side(found, 4096), "same", "left")
            .select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    "item_ids", "share"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    rows, key = with_key(docs)
    return drop_rows(rows, key, findings(by_key(rows, key), read(spark, sf_dir, "benchmark")))
