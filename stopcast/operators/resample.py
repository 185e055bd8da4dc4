"""Class-imbalance resampling.

All randomness is a hash of (seed, id) (G6), so every result is repeatable
and independent of partitioning.  "Draw m rows" is an exact cut on a global
position in hash order (``global_row_index``), never a one-task top-m.
SMOTE and Tomek links use the exact k-NN join (``knn``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.operators.knn import as_vector, knn_join, mutual_nn
from stopcast.operators.rowindex import global_row_index
from stopcast.semantics import hash_hex, hash_unit
from stopcast.session import materialize


def hash_key(seed: int, *cols) -> Column:
    """60-bit integer from md5(seed:cols) (same value in any SQL engine)."""
    return F.conv(F.substring(hash_hex(seed, *cols), 1, 15), 16, 10).cast("long")


def _count(df: DataFrame, cond: Column | None = None) -> Column:
    d = df if cond is None else df.where(cond)
    return d.agg(F.count(F.lit(1))).scalar()


def take_in_hash_order(df: DataFrame, m: Column | int, seed: int, id_col: str) -> DataFrame:
    """The ``m`` rows with the smallest hash(seed, id) (exact, distributed)."""
    keyed = df.withColumn("__hk", hash_key(seed, id_col))
    ix = global_row_index(keyed, order=("__hk", id_col), idx_col="__hidx")
    mm = m if isinstance(m, Column) else F.lit(m)
    return ix.where(F.col("__hidx") < mm).drop("__hk", "__hidx")


def shuffle_order(df: DataFrame, seed: int, id_col: str) -> DataFrame:
    """SET1: a repeatable shuffle = sort by hash(seed, id)."""
    return df.orderBy(hash_key(seed, id_col), id_col)


def undersample_ratio(df: DataFrame, ratio: float = 2.0, *, label: str = "target", id_col: str = "event_id",
                      seed: int = 42, shuffle: bool = True) -> DataFrame:
    """RS1 (+SET1): all positives and ``floor(ratio * n_pos)`` negatives drawn
    without replacement; rows stacked and shuffled."""
    pos = df.where(F.col(label) == 1)
    neg = df.where(F.col(label) != 1)
    m = F.floor(F.lit(ratio) * _count(pos))
    out = pos.unionByName(take_in_hash_order(neg, m, seed, id_col))
    return shuffle_order(out, seed + 1, id_col) if shuffle else out


def random_undersampler(df: DataFrame, sampling_strategy: float = 0.5, **kw) -> DataFrame:
    """RS2: majority cut until minority / majority = sampling_strategy."""
    return undersample_ratio(df, 1.0 / sampling_strategy, **kw)


def freq_undersample(df: DataFrame, *, q: float = 0.40, ratio: float = 5.0, label: str = "target",
                     freq: str = "user_frequency", id_col: str = "event_id") -> DataFrame:
    """RS6: keep users with frequency >= Q40; all positives plus the most
    frequent users' negatives at ``ratio``:1 (ties by id)."""
    from stopcast.operators.cleaning import freq_quantile
    f = freq_quantile(df, q, freq)
    pos = f.where(F.col(label) == 1)
    neg = f.where(F.col(label) != 1).withColumn("__nf", -F.col(freq))
    ix = global_row_index(neg, order=("__nf", id_col), idx_col="__i")
    keep = ix.where(F.col("__i") < F.floor(F.lit(ratio) * _count(pos))).drop("__nf", "__i")
    return pos.unionByName(keep)


def smote(df: DataFrame, *, k: int = 5, sampling_strategy: float | None = 0.5, label: str = "label",
          id_col: str = "id", vec: str = "vec", seed: int = 42) -> DataFrame:
    """RS3: synthetic minority rows until minority / majority reaches
    ``sampling_strategy`` (None = 'auto' = 1.0).

    Each minority row gets ``n_syn div n_min`` copies, plus one for the first
    ``n_syn mod n_min`` rows in hash order (exact total).  Copy j of row i
    takes neighbour rank ``1 + hash(i, j) mod k`` among its k nearest
    minority rows and the point ``x + u (nn - x)``, u = hash_unit(i, j).
    Returns the synthetic rows only: (id string, origin, copy, vec, label)."""
    s = 1.0 if sampling_strategy is None else sampling_strategy
    mino = materialize(df.where(F.col(label) == 1).select(F.col(id_col).alias("__id"), as_vector(vec).alias("__v")))
    n1 = _count(mino)
    n0 = _count(df, F.col(label) != 1)
    n_syn = F.greatest(F.floor(F.lit(s) * n0) - n1, F.lit(0))
    keyed = mino.withColumn("__hk", hash_key(seed, "__id"))
    ix = global_row_index(keyed, order=("__hk", "__id"), idx_col="__r")
    copies = F.floor(n_syn / n1) + (F.col("__r") < (n_syn % n1)).cast("long")
    rows = ix.withColumn("__c", copies).where(F.col("__c") > 0).select(
        "__id", "__v", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c"))).alias("copy"))
    neigh = knn_join(mino, mino, k, qid="__id", tid="__id", qvec="__v", tvec="__v", carry=["__v"], exclude_self=True,
                     qout="__id", tout="__nid")
    avail = neigh.groupBy("__id").agg(F.max("rank").alias("__ka"))
    rows = rows.join(avail, "__id", "inner").withColumn(
        "rank", (F.lit(1) + F.pmod(hash_key(seed + 1, "__id", "copy"), F.col("__ka").cast("long"))).cast("int"))
    j = rows.join(neigh.select("__id", "rank", F.col("__v").alias("__nv")), ["__id", "rank"], "inner")
    u = hash_unit(seed + 2, "__id", "copy")
    return j.select(F.concat_ws(":", F.lit("s"), F.col("__id").cast("string"), F.col("copy").cast("string")).alias(id_col),
                    F.col("__id").alias("origin"), "copy",
                    F.zip_with("__v", "__nv", lambda a, b: a + u * (b - a)).alias(vec), F.lit(1).alias(label))


def with_smote(df: DataFrame, *, label: str = "label", id_col: str = "id", vec: str = "vec", **kw) -> DataFrame:
    """Original rows (ids prefixed 'o:') + SMOTE rows, vectors as double."""
    orig = df.select(F.concat_ws(":", F.lit("o"), F.col(id_col).cast("string")).alias(id_col),
                     as_vector(vec).alias(vec), F.col(label).cast("int").alias(label))
    syn = smote(df, label=label, id_col=id_col, vec=vec, **kw).select(id_col, vec, F.col(label).cast("int").alias(label))
    return orig.unionByName(syn)


def tomek_links(df: DataFrame, *, label: str = "label", id_col: str = "id", vec: str = "vec",
                drop: str = "majority", majority: int = 0) -> DataFrame:
    """RS4 (drop='majority'): remove the majority member of every Tomek link;
    RS5 cleaning (drop='both') removes both members."""
    links = mutual_nn(df, id_col=id_col, vec=vec, label=label)
    if drop == "both":
        gone = links.select(F.col("a").alias("__g")).unionByName(links.select(F.col("b").alias("__g")))
    else:
        gone = (links.select(F.when(F.col("label_a") == majority, F.col("a")).otherwise(F.col("b")).alias("__g")))
    return df.join(gone.distinct(), F.col(id_col) == F.col("__g"), "left_anti")


def smote_tomek(df: DataFrame, *, label: str = "label", id_col: str = "id", vec: str = "vec", **kw) -> DataFrame:
    """RS5: SMOTE (0.5) then Tomek cleaning of both members."""
    return tomek_links(materialize(with_smote(df, label=label, id_col=id_col, vec=vec, **kw)), label=label,
                       id_col=id_col, vec=vec, drop="both")
