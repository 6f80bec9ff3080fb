"""Line dedup by a deletion-neighbourhood join (operator 7), DataFrame
functions only.

A line with at least ``min_words`` words is removed when an earlier line
(by doc_id, then line number) lies within one word of it: equal, or one
word inserted, deleted or replaced.  Shorter lines always stay.

1. Lines that are equal as strings form a class with its first place.
2. Two different lines within one word share their first or their last half
   (the edit falls into one of them), so classes that share neither half
   with another class are done.  This drops no pair.
3. The rest emit their deletion neighbourhood as hashed keys: the line
   without word i for every i outside a shared half, and the line itself.  Equal (length, i, rest)
   keys are equal lines but for word i; a full line that equals another's
   variant is that line less one word.  The first place of each key is
   aggregated and joined to all of the key's lines, so a group of any size
   costs one row per line and variant and no pairs.
4. The edit distance of each remaining (line, witness) is verified on the
   words before the line is dropped.

Defined cases: null text has no lines and stays null; rows with equal
doc_id and text are one document; a null doc_id sorts last; an empty table
gives an empty table; other columns are carried, never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, discard, documents, let, materialise

MIN_WORDS = 8
LAST = 9223372036854775807


def _place(line_no: Column) -> Column:
    return F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.col("text_key").alias("t"), line_no.alias("l"))


def _line_words(line: Column) -> Column:
    """Words of a line; a line without tabs and the like is split at spaces,
    which needs no pattern."""
    parts = F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, SPACES)).otherwise(F.split(line, " "))
    return F.array_remove(parts, "")


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Lines of at least ``min_words`` words, with the words.  The document's
    key and the words are evaluated below the generator: once per document
    and once per line."""
    parts = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), _line_words(x).alias("w")))
    return (docs.where(F.col("text").isNotNull())
            .select("doc_id", F.xxhash64("text").alias("text_key"), parts.alias("parts"))
            .select("doc_id", "text_key", F.posexplode("parts").alias("line_no", "part"))
            .where(F.size("part.w") >= min_words)
            .select("doc_id", "text_key", "line_no", "part.line", "part.w"))


def _keys(line: Column) -> Column:
    """128 bits that stand for the raw line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def _halves(w: Column, n: Column) -> Column:
    """Keys of the first and last half (1, 2) for the line's own length, then
    (3, 4) for one word less, the length of a line that lacks one word."""
    out = []
    for c in (n, n - 1):
        h = F.floor(c / 2).cast("int")
        tail = (c - h).cast("int")
        out += [F.xxhash64(F.lit("first"), c, F.slice(w, F.lit(1), h)),
                F.xxhash64(F.lit("last"), c, F.slice(w, n - tail + 1, tail))]
    return F.array(*out)


def _variants(w: Column, n: Column, shared: Column) -> Column:
    """(key, kind): 0 the line itself, 1 the line less one word anywhere,
    2 the line less word i, by i.  ``shared``: numbers of the halves shared
    with other lines; only the words of the other half can be the edit."""
    has = lambda k: F.array_contains(shared, k)
    rest = lambda i: F.xxhash64(n - 1, F.slice(w, F.lit(1), i - 1), F.slice(w, i + 1, n - i))
    own = F.array(F.struct(F.xxhash64(n, w, F.array().cast("array<string>")).alias("key"), F.lit(0).alias("kind")))

    def less(first, last, h, key, kind):
        at = F.filter(F.sequence(F.lit(1), n), lambda i: F.when(i <= h, has(last)).otherwise(has(first)))
        return F.transform(at, lambda i: F.struct(key(i).alias("key"), F.lit(kind).alias("kind")))

    return F.concat(
        own,
        less(3, 4, F.floor((n - 1) / 2), lambda i: F.xxhash64(n - 1, F.concat(
            F.slice(w, F.lit(1), i - 1), F.slice(w, i + 1, n - i)), F.array().cast("array<string>")), 1),
        less(1, 2, F.floor(n / 2), lambda i: F.xxhash64(rest(i), i), 2))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word edit apart."""
    na, nb = F.size(a), F.size(b)
    longer, shorter = F.when(na >= nb, a).otherwise(b), F.when(na >= nb, b).otherwise(a)
    return (F.abs(na - nb) <= 1) & let(
        F.struct(longer.alias("x"), shorter.alias("y")),
        lambda p: let(
            # words that agree from the front
            F.aggregate(p["y"], F.struct(F.lit(0).alias("i"), F.lit(0).alias("same")),
                        lambda s, v: F.struct((s["i"] + 1).alias("i"), F.when(
                            (s["same"] == s["i"]) & (F.get(p["x"], s["i"]) == v), s["same"] + 1)
                            .otherwise(s["same"]).alias("same")), lambda s: s["same"]),
            lambda k: F.slice(p["x"], k + 2, F.size(p["x"])) == F.when(
                F.size(p["x"]) > F.size(p["y"]), F.slice(p["y"], k + 1, F.size(p["x"])))
            .otherwise(F.slice(p["y"], k + 2, F.size(p["x"])))))


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, line_no) of every line to remove."""
    lines = _lines(docs, min_words)
    places = materialise(lines.select(
        "doc_id", "text_key", "line_no", _keys(F.col("line")).alias("k"), F.size("w").alias("n"),
        _halves(F.col("w"), F.size("w")).alias("halves")), "lines")
    classes = materialise(
        places.groupBy("k").agg(F.min(_place(F.col("line_no"))).alias("first"),
                                F.first("n").alias("n"), F.first("halves").alias("halves")), "line-classes")

    # classes that share a half with another class; for the halves of one word
    # less, with a class that is one word shorter
    half = classes.select(F.col("k.a").alias("a"), "n", F.posexplode("halves").alias("slot", "half"))
    shared = (half.groupBy("half").agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.min("n").alias("short"))
              .where("lo <> hi").select("half", "short"))
    open_a = (half.join(shared, "half").where("slot < 2 or short < n")
              .groupBy("a").agg(F.collect_set(F.col("slot") + 1).alias("shared")))
    open_classes = materialise(classes.join(open_a, F.col("k.a") == F.col("a"))
                               .select("k", "first", "shared"), "line-open")

    # the words of those classes, from the line at the first place
    text = (lines.drop("w").withColumn("k", _keys(F.col("line"))).withColumn("place", _place(F.col("line_no")))
            .join(open_classes.withColumnRenamed("k", "_k"),
                  (F.col("k") == F.col("_k")) & (F.col("place") == F.col("first")))
            .select("k", "first", "shared", "line").dropDuplicates(["k"]))
    near = materialise(text.select("k", "first", "shared", _line_words(F.col("line")).alias("w")), "line-words")

    keys = materialise(near.select("k", "first", F.explode(_variants(F.col("w"), F.size("w"), F.col("shared"))).alias("v"))
                       .select("k", "first", "v.key", "v.kind"), "line-variants")
    # first place among the lines of a key, by kind of member
    one = keys.groupBy("key").agg(
        F.min(F.when(F.col("kind") == 0, F.struct("first", "k"))).alias("full"),
        F.min(F.when(F.col("kind") == 1, F.struct("first", "k"))).alias("less"),
        F.min(F.when(F.col("kind") == 2, F.struct("first", "k"))).alias("sub"),
        F.count(F.lit(1)).alias("members")).where("members > 1")
    witness = (keys.join(one, "key")
               .withColumn("by", F.when(F.col("kind") == 0, F.least("full", "less"))
                           .when(F.col("kind") == 1, F.col("full")).otherwise(F.col("sub")))
               .where(F.col("by.first") < F.col("first"))
               .select("k", F.col("by.k").alias("by_k")).distinct())
    w1 = near.select("k", "w")
    w2 = near.select(F.col("k").alias("by_k"), F.col("w").alias("by_w"))
    near_gone = (witness.join(w1, "k").join(w2, "by_k").where(_within_one(F.col("w"), F.col("by_w")))
                 .select("k").distinct().withColumn("near", F.lit(True)))

    state = classes.select("k", "first").join(near_gone, "k", "left")
    gone = materialise(places.select("doc_id", "text_key", "line_no", "k").join(state, "k")
                       .where(F.col("near").isNotNull() | (_place(F.col("line_no")) != F.col("first")))
                       .select("doc_id", "text_key", "line_no").distinct(), "line-gone")
    discard(places, classes, open_classes, near, keys)
    return gone


def _by_document(removed: DataFrame) -> DataFrame:
    return removed.groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).agg(
        F.sort_array(F.collect_list("line_no")).alias("_gone"))


def _attach(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(gone, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_d")), "left")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text``; a document all of
    whose words went is dropped, every other row and column stays."""
    gone = _by_document(removed_lines(docs, min_words))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"))
    kept = F.array_join(F.filter(F.split(F.col("_row.text"), "\n"),
                                 lambda x, i: ~F.array_contains("_gone", i)), "\n")
    out = _attach(row, gone).withColumn("_text", F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(kept))
    return (out.where(F.col("_gone").isNull() | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
            .select(F.col("_row").withField("text", F.col("_text")).alias("_row")).select("_row.*"))


def op7_line_dedup(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    base = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"),
                       F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    out = _attach(base, _by_document(removed_lines(docs)))
    return out.select(F.col("_id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join("_gone", ","), F.lit("")).alias("removed_lines"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM d),
lw AS (SELECT doc_id, i, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l),
e AS (SELECT * FROM lw WHERE len(w) >= {MIN_WORDS}),
f AS (SELECT line, any_value(w) AS w, min((doc_id, i)) AS first FROM e GROUP BY line),
s AS (SELECT line, w, first, unnest(range(1, len(w) + 1)) AS p FROM f),
v AS (SELECT line, first, p, len(w) AS n,
             array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS rest FROM s),
sub AS (SELECT line FROM (SELECT line, first, min(first) OVER (PARTITION BY n, p, rest) AS m FROM v) WHERE m < first),
full_line AS (SELECT line, first, array_to_string(w, ' ') AS body FROM f),
ins AS (SELECT v.line FROM v JOIN full_line x ON v.rest = x.body AND x.first < v.first),
del AS (SELECT x.line FROM v JOIN full_line x ON v.rest = x.body AND v.first < x.first),
same AS (SELECT line FROM (SELECT line, first, min(first) OVER (PARTITION BY body) AS m FROM full_line) WHERE m < first),
near AS (SELECT line FROM sub UNION SELECT line FROM ins UNION SELECT line FROM del UNION SELECT line FROM same),
gone AS (SELECT e.doc_id, e.i FROM e JOIN f ON e.line = f.line
         WHERE (e.doc_id, e.i) > f.first OR e.line IN (SELECT line FROM near)),
g AS (SELECT doc_id, count(*) AS c, string_agg(i, ',' ORDER BY i) AS a FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(c, 0)::BIGINT AS n_removed, coalesce(a, '') AS removed_lines
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
