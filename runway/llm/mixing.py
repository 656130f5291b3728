"""Operator 6: mix sources to target weights.

Every row gets a hash-random key; rows are range-sorted by (source, key), so one source spans as many partitions
as it needs, and distributed prefix sums of sizes say where each source's budget ends.  A budget of e whole
passes over a source and a rest r takes every row e times, the rows whose words lie before r once more, and of
the row in which r falls just the words up to r.

Defined cases: a NULL text has size 0 and is taken 0 times; a NULL source is a source, the last one; repeated
rows are rows like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import WORD, packed, running_totals, stage, unpacked


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """One narrow row per document: size in words, digest of the text, hash-random key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(F.col(text_col)).alias("digest"), key.alias("sort_key"))


def source_targets(rows: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """(source, source_size, weight, target) with the targets adding up to all sizes.

    Targets are the level times the weight, at most ``most_epochs`` sizes.  Sources in the order of the level at
    which they reach that bound: the first that stays below it, given that all before it are at theirs, fixes
    the level.
    """
    sources = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
                    .withColumn("one", F.lit(1).cast("long")), "mix_sources")
    ranked = running_totals(sources, [], ["source"], {"rank": "one"})
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("bound", most_epochs * F.col("source_size"))
    ranked = ranked.withColumn("reach", F.col("bound") / F.col("weight"))
    ranked = stage(running_totals(ranked, [], ["reach", "source"], {"bound_before": "bound", "weight_before": "weight"}),
                   "mix_levels")
    total = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = 0.0
    if total["size"]:
        at = (F.lit(total["size"]) - F.col("bound_before")) / (F.lit(total["weight"]) - F.col("weight_before"))
        first = (ranked.withColumn("level", at.cast("double")).where(F.col("level") <= F.col("reach"))
                 .agg(F.min_by("level", F.struct("reach", F.col("source").isNull(), "source")).alias("level")).first())
        level = first["level"]
    target = F.least(F.lit(level) * F.col("weight"), F.col("bound").cast("double"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, words_before, digest."""
    rows = stage(sized(docs, id_col, text_col, source_col, seed), "mix_sizes")
    targets = source_targets(rows, weights, most_epochs)
    placed = running_totals(rows, ["source"], ["sort_key", "doc_id", "size", "digest"], {"words_before": "size"})
    t = targets.withColumnRenamed("source", "_source").drop("weight")
    placed = placed.join(t, placed["source"].eqNullSafe(t["_source"])).drop("_source")
    budget = F.floor(F.col("target") + 0.5)
    rest = F.least(F.greatest(budget % F.col("source_size") - F.col("words_before"), F.lit(0)), F.col("size"))
    taken = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(budget / F.col("source_size")) * F.col("size") + rest)
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                         F.col("words_before").cast("long").alias("words_before"), "digest")


def first_words(text: str, n: int) -> str:
    """The text up to the end of its ``n``-th word; NULL stays NULL."""
    if text is None:
        return None
    data = text.encode()
    end = 0
    for word in data.split(None, n)[:n]:
        end = data.index(word, end) + len(word)
    return data[:end].decode()


def mixed_documents(docs: DataFrame, plan: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each pass over a document, the last one cut where the
    budget ends (``text`` and ``n_chars`` then follow).  Rows equal in doc_id, source and text share what they take
    evenly, to the word."""
    plan = mix(docs, **options) if plan is None else plan
    share = plan.groupBy("doc_id", "source", "digest").agg(
        F.sum("taken").alias("_taken"), F.count("*").alias("_copies"), F.first("size").alias("_size")).where("_taken > 0")
    share = stage(share.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"),
                               "_taken", "_copies", "_size"), "mix_share")
    rows = packed(docs, doc=F.col("doc_id"), of=F.col("source"), text_digest=F.xxhash64("text"))
    taken = rows.join(share, F.col("doc").eqNullSafe(F.col("_id")) & F.col("of").eqNullSafe(F.col("_source"))
                      & (F.col("text_digest") == F.col("_digest"))).select("row", *share.columns)
    # Copies are numbered; the first ones take a word more where the words of all do not divide evenly.
    copies = taken.where("_copies > 1").withColumn("_salt", F.monotonically_increasing_id()).withColumn("_one", F.lit(1).cast("long"))
    copies = running_totals(copies, ["_id", "_source", "_digest"], ["_salt"], {"_copy": "_one"}).drop("_salt", "_one")
    taken = taken.where("_copies = 1").withColumn("_copy", F.lit(0).cast("long")).unionByName(copies)
    mine = F.floor(F.col("_taken") / F.col("_copies")) + (F.col("_copy") < F.col("_taken") % F.col("_copies")).cast("long")
    taken = taken.select("row", F.floor(mine / F.col("_size")).alias("_whole"), (mine % F.col("_size")).alias("_rest"))
    passes = F.when(F.col("_rest") > 0, F.array_append(F.array_repeat(F.lit(-1).cast("long"), F.col("_whole").cast("int")),
                                                       F.col("_rest"))).otherwise(
        F.array_repeat(F.lit(-1).cast("long"), F.col("_whole").cast("int")))
    rows = taken.select("row", F.explode(passes).alias("_words"))
    cut = F.udf(first_words, "string")  # has text to cut in one row of each source, gets NULL in the others
    text = F.col("row")["text"]
    rows = rows.withColumn("_text", F.coalesce(cut(F.when(F.col("_words") >= 0, text), "_words"), text))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return unpacked(rows, docs.columns, **changed)
