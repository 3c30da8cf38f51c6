"""Deduplication of training examples: exact, structural and semantic, each keeping the first of its like.

An example is ord (its place), instruction, input, output, source; null fields count as empty.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.text import squash, word_tokens


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile  # a single machine, as in tests

        root = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to a shared folder and read back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def content() -> Column:
    """output, input and instruction, those that aren't empty, joined by a space."""
    part = lambda c: F.when(F.col(c) != "", F.col(c))
    return F.concat_ws(" ", part("output"), part("input"), part("instruction"))


def exact(examples: DataFrame, min_length: int = 50) -> DataFrame:
    """The first of all with one squashed content; contents shorter than min_length always stay. Only a key and ord are shuffled, with a partial minimum; the texts stay where they are read unless the joined keys are large."""
    key = F.when(F.length(content()) < min_length, F.concat(F.lit("short-"), F.col("ord").cast("string"))).otherwise(F.md5(squash(content())))
    keyed = examples.withColumn("__key", key)
    first = keyed.groupBy("__key").agg(F.min("ord").alias("ord")).select("ord")
    return examples.join(first, "ord", "left_semi")


def clusters(examples: DataFrame) -> DataFrame:
    """Contents held more than once: the first 8 digits of their hash, how many, and the smallest and largest ord."""
    h = F.md5(squash(content()))
    return examples.groupBy(h.alias("hash")).agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"), F.countDistinct("source").alias("n_sources")).filter("n > 1").withColumn("hash", F.left("hash", F.lit(8)))


def members(examples: DataFrame) -> DataFrame:
    """hash, ord, source, place: every example whose content is held more than once, numbered within its cluster by ord. A row each, as a cluster may hold most examples."""
    held = examples.select(F.md5(squash(content())).alias("hash"), "ord", "source")
    many = held.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    w = Window.partitionBy("hash").orderBy("ord")
    return held.join(many, "hash").withColumn("place", F.row_number().over(w)).select(F.left("hash", F.lit(8)).alias("hash"), "ord", "source", "place")


def features(examples: DataFrame) -> DataFrame:
    """ord, whether there is an input and an instruction, source, the three lengths and the set of the first ten words of output."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return examples.select(
        "ord", (text("input") != "").alias("has_input"), (text("instruction") != "").alias("has_instruction"), text("source").alias("source"),
        *(F.length(text(c)).alias(f"n_{c}") for c in ("output", "input", "instruction")),
        F.array_distinct(F.slice(word_tokens(text("output")), 1, 10)).alias("words"),
    )


#: Rows of a key that meet in one task: keys with more are cut into blocks of which every two meet.
BLOCK = 2000


def representatives(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows (ord, and columns) reduced to one for each class of rows that are equal in the columns `by`: the smallest ord, those columns, and `size`, how many there are."""
    return rows.groupBy(*by).agg(F.min("ord").alias("ord"), F.count("*").alias("size"))


def meeting(keyed: DataFrame, keys: list[str], df: str, block: int | None = None, similarity: Column | None = None, carried: tuple[str, ...] = (), here: Column | None = None, threshold: float = 0.0) -> DataFrame:
    """The distinct pairs a < b of ord that share a key. df: a column with how many rows the row's key has. similarity: of the columns `carried`, named a_ and b_ and alike both ways; only pairs that reach the threshold leave the task they meet in, with it. here: of the same columns, holds at one of the keys that a pair shares, so that pairs needn't be shuffled to be distinct.

    A key's rows are cut into blocks by a hash of ord, and each two blocks meet in a group of their own, so that a task
    holds two blocks of any key, however many rows it has.
    """
    block = block or BLOCK
    n = F.greatest(F.lit(1), F.ceil(F.col(df) / block)).cast("int")
    own = lambda x: [F.col(c).alias(f"{x}_{c}") for c in carried]
    at = keyed.select("ord", *keys, *carried, n.alias("n"), F.pmod(F.xxhash64("ord"), n).cast("int").alias("own"))
    left = at.withColumn("other", F.explode(F.sequence(F.col("own"), F.col("n") - 1))).select(F.col("ord").alias("a"), *keys, *own("a"), F.col("own").alias("i"), F.col("other").alias("j"))
    right = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own")))).select(F.col("ord").alias("b"), *keys, *own("b"), F.col("other").alias("i"), F.col("own").alias("j"))
    met = left.join(right, [*keys, "i", "j"]).filter((F.col("a") < F.col("b")) | ((F.col("i") < F.col("j")) & (F.col("a") > F.col("b"))))
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    if similarity is None:
        return met.select(*ends).distinct()
    return met.filter(here).select(*ends, similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


FEATURES = ["has_input", "has_instruction", "source", "n_output", "n_input", "n_instruction", "words"]


def structural_classes(examples: DataFrame) -> DataFrame:
    """ord, class: the smallest ord of the examples that have the same features. Examples without words, which are similar to none, are classes of their own."""
    f = stored(features(examples).withColumn("words", F.array_sort("words")), "features")
    least = representatives(f.filter(F.size("words") > 0), FEATURES).select(*FEATURES, F.col("ord").alias("class"))
    return f.join(least, FEATURES, "left").select("ord", F.coalesce("class", "ord").alias("class"))


def structural_pairs(examples: DataFrame, threshold: float = 0.85) -> DataFrame:
    """a < b and their similarity, at least threshold, of examples that are the first of their structural classes; those of one class have similarity 1. threshold must be above 1 / 1.2: then unlike flags or sources can't reach it, and two similar examples share a word, so both are keys of an equi-join. Only the rarest words of each are, as many as the least overlap of words asks for."""
    if threshold <= 1.0 / 1.2:
        raise ValueError("threshold must be above 1 / 1.2")
    # what is similar enough shares so much of its words that it shares one of its rarest; the lengths do the rest
    least = (1.2 * threshold - 0.9) / 0.3
    f = stored(representatives(features(examples).withColumn("words", F.array_sort("words")), FEATURES), "structural")
    same = ["has_input", "has_instruction", "source"]
    lengths = ["n_output", "n_input", "n_instruction"]
    e = f.select("ord", *same, *lengths, F.explode("words").alias("word"), F.size("words").alias("n_words"))
    df = e.groupBy(*same, "word").agg(F.count("*").alias("df"))
    # an example's words that others have, the rarest first, ten at most
    ranked = e.join(df.filter("df > 1"), [*same, "word"]).groupBy("ord", *same, *lengths, "n_words").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("ranked"))
    rarest = F.size("ranked") - F.ceil(F.lit(least) * F.col("n_words") - 1e-9).cast("int") + 1
    rare = ranked.withColumns({"words": F.col("ranked.word"), "rarest": F.greatest(F.lit(0), rarest)})
    rare = rare.select("ord", *same, *lengths, "n_words", "words", "rarest", F.posexplode(F.slice("ranked", F.lit(1), F.col("rarest"))).alias("place", "x")).select("*", "x.word", "x.df").drop("x")
    both = F.size(F.array_intersect("a_words", "b_words"))
    # a pair is made where the rarest word that it shares is the key
    first = lambda x: F.slice(f"{x}_words", F.lit(1), F.col(f"{x}_rarest"))
    here = F.get(F.array_intersect(first("a"), first("b")), F.lit(0)) == F.col("word")

    def near(c: str) -> Column:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        return F.when((x == 0) & (y == 0), 0.1).when((x > 0) & (y > 0), 0.1 * (1 - F.abs(x - y) / F.greatest(x, y))).otherwise(0.0)

    # added up as SQL does with exact decimals: what is equal before it is rounded, or at the threshold, depends on it
    alike = 0.6 + (near("n_input") + near("n_instruction")) + near("n_output")
    score = lambda n: (alike + 3 * n / 10 / (F.col("a_n_words") + F.col("b_n_words") - n)) / 1.2
    # at that key a pair shares no rarer words, so no more than those from it on: numbers settle most pairs before words are compared
    most = F.least(F.size("a_words") - F.col("a_place"), F.size("b_words") - F.col("b_place"))
    here = (score(most) >= threshold - 1e-9) & here
    return meeting(rare, [*same, "word"], "df", similarity=score(both), carried=(*lengths, "n_words", "words", "rarest", "place"), here=here, threshold=threshold)


def bags(examples: DataFrame) -> DataFrame:
    """ord, words, bag: the words of output and input, and a digest of them in any order."""
    text = F.concat_ws(" ", F.coalesce("output", F.lit("")), F.coalesce("input", F.lit("")))
    return examples.select("ord", word_tokens(text).alias("words")).withColumn("bag", F.sha2(F.array_join(F.sort_array("words"), " "), 256))


def semantic_classes(examples: DataFrame) -> DataFrame:
    """ord, class: the smallest ord of the examples that have the same words as often. Examples without words are classes of their own."""
    b = bags(examples).select("ord", "bag", (F.size("words") > 0).alias("any"))
    least = b.filter("any").groupBy("bag").agg(F.min("ord").alias("class"))
    return b.join(least, "bag", "left").select("ord", F.coalesce(F.when(F.col("any"), F.col("class")), F.col("ord")).alias("class"))


#: Words of known frequency that go to every task; pairs' examples that do, and rows of text that a task takes at once.
COMMON_WORDS, SENT_IDS, TEXT_ROWS = 500_000, 1_000_000, 512


def rare_and_leading(tokens: DataFrame, common: pa.Table, cut: int, n_docs: int, threshold: float) -> DataFrame:
    """ord, word, share, weight, sum, base: of tokens (ord, words) each word that isn't in common (word, df, from the most frequent on; of df `cut` at least) with its share of the example's words, and of those in it the ones that may be in the example's prefix, with their weight and the sum of squared weights up to them. base: that sum over all of the example's common words."""
    spark = tokens.sparkSession
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(int(before), TEXT_ROWS)))  # texts may be long
    held = spark.sparkContext.broadcast((common.column("word").combine_chunks(), common.column("df").to_numpy()))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = held.value
        for batch in batches:
            lists = batch.column("words")
            flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            place = pc.fill_null(pc.index_in(flat, value_set=known.cast(flat.type)), -1).to_numpy()
            rows: dict[str, list] = {c: [] for c in ("ord", "word", "share", "weight", "sum", "base")}

            def add(ord, words, share, weight, sums, base, rows=rows):
                for c, x in zip(rows, ([ord] * len(words), words, share, weight, sums, [base] * len(words)), strict=True):
                    rows[c].extend(x)

            for ord, start, end in zip(batch.column("ord").to_pylist(), ends[:-1], ends[1:], strict=True):
                x, total = place[start:end], int(end - start)
                if not total:
                    continue
                of, k = np.unique(x[x >= 0], return_counts=True)
                w = k / total * n_docs / (df[of] + 1)
                sums = np.cumsum(w * w)
                base = float(sums[-1]) if len(sums) else 0.0
                rare = Counter(flat.take(pa.array(np.flatnonzero(x < 0) + start)).to_pylist())
                # a word below the cut weighs its share times n_docs over the cut at least
                least = base + sum((n / total * n_docs / cut) ** 2 for n in rare.values())
                may = np.sqrt(sums / least) >= threshold - 1e-6 if least else sums < 0
                add(ord, known.take(pa.array(of[may])).to_pylist(), [None] * int(may.sum()), w[may].tolist(), sums[may].tolist(), base)
                add(ord, list(rare), [n / total for n in rare.values()], [None] * len(rare), [None] * len(rare), base)
            kinds = (batch.schema.field("ord").type, pa.string(), *[pa.float64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows.values(), kinds, strict=True)], names=list(rows))

    kind = tokens.schema["ord"].dataType.simpleString()
    try:
        return stored(tokens.select("ord", "words").mapInArrow(parts, f"ord {kind}, word string, share double, weight double, sum double, base double"), "leading")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def semantic_pairs(examples: DataFrame, threshold: float = 0.85) -> DataFrame:
    """a < b and the cosine of their TF-IDF vectors over the words of output and input, of examples that are the first of their semantic classes; those of one class have cosine 1. IDF is documents / (document frequency + 1) over all examples.

    Neither texts nor all words of examples are shuffled: the frequencies of the most frequent words go to every task,
    which sums the squares of their weights; only rarer words are joined with theirs. Pairs meet at the words of their
    prefixes, and full vectors are made of those alone that may be similar.
    """
    n_docs = examples.count()
    b = bags(examples)
    first = stored(b.groupBy("bag").agg(F.min("ord").alias("ord")).select("ord"), "firsts")
    df = stored(b.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df")), "frequencies")
    # the least power of two that few enough words have as df: a row for each doubling
    n, cut = 0, None
    for r in df.groupBy(F.floor(F.log2("df") + 1e-9).cast("int").alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect():
        n += r["n"]
        if n > COMMON_WORDS:
            break
        cut = 2 ** r["power"]
    cut = cut or 2**62
    common = df.filter(F.col("df") >= cut).orderBy(F.desc("df"), "word").toArrow()
    parts = rare_and_leading(b, common, cut, n_docs, threshold)
    # words by falling df, the common ones before the rare: the sums of squares go on from theirs
    rare = parts.filter("weight IS NULL").join(df, "word").withColumn("w", F.col("share") * n_docs / (F.col("df") + 1))
    whole = Window.partitionBy("ord")
    upto = whole.orderBy(F.desc("df"), "word").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("w") * F.col("w")
    rare = stored(rare.select("ord", "word", "df", "w", (F.col("base") + F.sum(square).over(upto)).alias("sum"), (F.col("base") + F.sum(square).over(whole)).alias("norm2")), "rare")
    norms = rare.groupBy("ord").agg(F.first("norm2").alias("norm2"))
    lead = parts.filter("weight IS NOT NULL").join(norms, "ord", "left").select("ord", "word", F.col("weight").alias("w"), "sum", F.coalesce("norm2", "base").alias("norm2"))
    # the words of least df that can be left out without losing a pair: their squared weights sum below threshold squared
    prefix = rare.filter("df > 1").drop("df").unionByName(lead).select("ord", "word", (F.col("w") / F.sqrt("norm2")).alias("u"), F.sqrt(F.col("sum") / F.col("norm2")).alias("left"))
    prefix = stored(prefix.filter(F.col("left") >= threshold - 1e-9).join(first, "ord", "left_semi"), "prefix")
    classes = prefix.groupBy("word").agg(F.count("*").alias("classes")).filter("classes > 1")
    # the rarest word that a pair shares is among those of both, as all rarer ones of each are; what they share besides is among the words that are left
    rest = lambda x: F.sqrt(F.greatest(F.lit(0.0), F.col(f"{x}_left") * F.col(f"{x}_left") - F.col(f"{x}_u") * F.col(f"{x}_u")))
    most = F.col("a_u") * F.col("b_u") + rest("a") * rest("b")
    pairs = stored(meeting(prefix.join(classes, "word"), ["word"], "classes", similarity=most, carried=("u", "left"), here=F.lit(True), threshold=threshold - 1e-6).select("a", "b").distinct(), "candidates")
    near = stored(pairs.select(F.col("a").alias("ord")).unionByName(pairs.select(F.col("b").alias("ord"))).distinct(), "near")
    kept = bags(examples.join(F.broadcast(near) if near.count() <= SENT_IDS else near, "ord", "left_semi"))
    tf = kept.select("ord", F.size("words").alias("total"), F.explode("words").alias("word")).groupBy("ord", "total", "word").agg(F.count("*").alias("k"))
    weighted = stored(tf.join(df, "word").select("ord", "word", (F.col("k") / F.col("total") * n_docs / (F.col("df") + 1)).alias("w")), "weighted")
    norm = weighted.groupBy("ord").agg(F.sqrt(F.sum(square)).alias("norm"))
    unit = stored(weighted.join(norm, "ord").select("ord", "word", (F.col("w") / F.col("norm")).alias("u")), "unit")
    dot = pairs.join(unit.select(F.col("ord").alias("a"), "word", F.col("u").alias("ua")), "a").join(unit.select(F.col("ord").alias("b"), "word", F.col("u").alias("ub")), ["b", "word"])
    return dot.groupBy("a", "b").agg(F.sum(F.col("ua") * F.col("ub")).alias("similarity")).filter(F.col("similarity") >= threshold)


def members_pairs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """a < b and their similarity, of all examples: links (a, b, similarity) between the first examples of classes (ord, class) hold for each two of their members, and members of one class have similarity 1. What a hot class makes is dealt out in blocks."""
    of = stored(classes, "classes")
    member = lambda c, x: of.select(F.col("class").alias(c), F.col("ord").alias(x))
    across = stored(links, "links").join(member("a", "x"), "a").join(member("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
    many = of.groupBy("class").agg(F.count("*").alias("size")).filter("size > 1")
    return across.unionByName(meeting(of.join(many, "class"), ["class"], "size", similarity=F.lit(1.0), here=F.lit(True)))


def keep_first(examples: DataFrame, pairs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """The examples that greedy keep-first leaves: each that is similar to no kept earlier one. In rounds, one with no undecided or kept earlier neighbour is kept, and one with a kept earlier neighbour goes; each round's decisions are written to the checkpoint folder.

    classes (ord, class): pairs are those of the first examples of classes, and of each class no other can stay, as it is
    similar to what its first is similar to, and to that one itself.
    """
    if classes is not None:
        examples = examples.join(classes.filter("ord = class").select("ord"), "ord", "left_semi")
    open_pairs = stored(pairs.select("a", "b"), "keep-first")
    gone = None
    while open_pairs.limit(1).count():
        blocked = open_pairs.select(F.col("b").alias("a")).distinct()
        kept = open_pairs.select("a").distinct().join(blocked, "a", "left_anti")
        dropped = stored(open_pairs.join(kept, "a", "left_semi").select(F.col("b").alias("a")).distinct(), "keep-first")
        gone = dropped if gone is None else gone.unionByName(dropped)
        # of kept ones all pairs are settled, and a dropped one neither keeps nor drops others
        settled = kept.unionByName(dropped)
        open_pairs = stored(open_pairs.join(settled, "a", "left_anti").join(dropped.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b"), "keep-first")
    return examples if gone is None else examples.join(gone.withColumnRenamed("a", "ord"), "ord", "left_anti")


def structural(examples: DataFrame, threshold: float = 0.85) -> DataFrame:
    """What greedy keep-first leaves of structurally similar examples."""
    return keep_first(examples, structural_pairs(examples, threshold), structural_classes(examples))


def semantic(examples: DataFrame, threshold: float = 0.85) -> DataFrame:
    """What greedy keep-first leaves of examples with similar words."""
    return keep_first(examples, semantic_pairs(examples, threshold), semantic_classes(examples))


def source_counts(examples: DataFrame) -> DataFrame:
    """Per source: how many, how many outputs under 100, under 500 and longer, and the mean length."""
    n = F.length(F.coalesce("output", F.lit("")))
    return examples.groupBy("source").agg(F.count("*").alias("n"), F.count_if(n < 100).alias("short"), F.count_if((n >= 100) & (n < 500)).alias("medium"), F.count_if(n >= 500).alias("long"), F.round(F.avg(n), 6).alias("mean_length"))


def report(examples: DataFrame, min_length: int = 50, threshold: float = 0.85, with_semantic: bool = False) -> tuple[DataFrame, DataFrame]:
    """What exact, structural and, if asked, semantic deduplication leave one after another, and a row a stage with how many it was given and removed."""
    stages = [("exact", lambda e: exact(e, min_length)), ("structural", lambda e: structural(e, threshold))]
    stages += [("semantic", lambda e: semantic(e, threshold))] if with_semantic else []
    counts = []
    for name, stage in stages:
        kept = stored(stage(examples), "kept")
        counts.append(examples.agg(F.count("*").alias("n_in")).crossJoin(kept.agg(F.count("*").alias("n_out"))).select(F.lit(name).alias("stage"), "n_in", (F.col("n_in") - F.col("n_out")).alias("removed")))
        examples = kept
    return examples, reduce(DataFrame.unionByName, counts)
