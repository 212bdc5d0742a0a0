"""Shards by jump consistent hashing: DataFrame functions only.

The shard of a document follows from its id and the number of shards alone. No
ring or table of shards is kept; with one shard more, only the rows that move
into the new shard change place, and they are about one in ``n_shards + 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import settled

#: Fixed values of the jump hash: the multiplier of its 64-bit generator, in parts of 32 and 16 bits, and 2^31.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW_1, _LOW_0 = _LOW >> 16, _LOW & 0xFFFF
_MASK = 0xFFFFFFFF
_RANGE = float(1 << 31)
#: More jumps than any key is likely to need below 10^12 shards; those that do need more go on from there.
_FEW = 64
#: Rows that one window group of slots holds on average.
_GROUP = 1000


def key_halves(column: Column) -> tuple[Column, Column]:
    """The 64-bit key of an id as two unsigned halves: the first eight bytes of the MD5 of its text; a null id is the empty text."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def _jump(state: Column, n_shards: int) -> Column:
    """The next jump of a state that has not yet passed the last shard.

    One step of the generator, ``key * MULTIPLIER + 1`` modulo 2^64, in halves
    and quarters so that no product overflows a long.
    """
    hi, lo = state["hi"], state["lo"]
    quarter = F.shiftleft((lo * _LOW_1).bitwiseAND(0xFFFF), 16)

    def stepped(low: Column) -> Column:
        high = (
            F.shiftright(low, 32) + F.shiftright(lo * _LOW_1, 16) + hi * _LOW_0
            + F.shiftleft((hi * _LOW_1).bitwiseAND(0xFFFF), 16) + lo * _HIGH
        )
        return F.struct(high.bitwiseAND(_MASK).alias("hi"), low.bitwiseAND(_MASK).alias("lo"))

    def moved(key: Column) -> Column:
        reach = (state["j"] + 1) * (F.lit(_RANGE) / (F.shiftright(key["hi"], 1) + 1))
        return F.struct(key["hi"].alias("hi"), key["lo"].alias("lo"), state["j"].alias("b"), F.floor(reach).alias("j"))

    return F.when(state["j"] >= n_shards, state).otherwise(_let(_let(lo * _LOW_0 + 1 + quarter, stepped), moved))


def with_jump(df: DataFrame, key: Column, n_shards: int, name: str) -> DataFrame:
    """``df`` and a struct ``name`` whose ``b`` is the shard and ``j`` the first shard number at which the key would move on."""
    if n_shards < 1:
        raise ValueError("at least one shard")
    hi, lo = key_halves(key)
    state = F.struct(hi.alias("hi"), lo.alias("lo"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def folded(start: Column, first: int, last: int) -> Column:
        return F.aggregate(F.sequence(F.lit(first), F.lit(last)), start, lambda s, _: _jump(s, n_shards))

    df = df.withColumn(name, folded(state, 1, min(n_shards, _FEW)))
    if n_shards > _FEW:  # a jump leads at least one shard on, so n_shards jumps always do
        df = df.withColumn(name, F.when(F.col(name)["j"] >= n_shards, F.col(name)).otherwise(folded(F.col(name), _FEW + 1, n_shards)))
    return df


def _shard(n_shards: int) -> tuple[Column, Column]:
    """The shard, and the one with one shard more, of a row that has ``__jump``."""
    b, j = F.col("__jump")["b"], F.col("__jump")["j"]
    return b.cast("int"), F.when(j == n_shards, j).otherwise(b).cast("int")


def assign(docs: DataFrame, n_shards: int, id_col: str = "doc_id") -> DataFrame:
    """The documents with their ``shard`` and ``grown_shard``, the shard if there were one more; nothing is shuffled.

    Columns of these names are replaced, all others kept, whatever their names.
    A null id is a key like any other. Rows that repeat an id share its shard.
    """
    rows = docs.select(F.col(id_col).alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    shard, grown = _shard(n_shards)
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in ("shard", "grown_shard")]
    return with_jump(rows, F.col("__key"), n_shards, "__jump").select(*kept, shard.alias("shard"), grown.alias("grown_shard"))


def manifest(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 16, ``slot`` the gapless place
    in the shard, in the order of a hash of id, size and checksum, so that it does
    not depend on how the table is stored. A null text has no bytes and the
    checksum 0, as an empty one. Rows equal in all three are counted before the
    shuffle and given consecutive slots; no rows give no rows.

    Slots are numbered in groups of about a thousand rows, a shard and a range of
    that hash, and the groups' counts are added up; so neither a shard nor a
    repeated row is ever in one task whole.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    counted = rows.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    shard, grown = _shard(n_shards)
    order = F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), "size", "text_crc32").cast("binary"))
    placed = settled(
        with_jump(counted, F.col("id"), n_shards, "__jump").select(
            "id", "size", "text_crc32", "copies", shard.alias("shard"), grown.alias("grown_shard"), order.alias("place")
        )
    )
    groups = max(1, -(-placed.count() // (n_shards * _GROUP)))
    part = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * groups / F.lit(2.0**32))
    placed = placed.withColumn("part", part)
    before = W.partitionBy("shard").orderBy("part")
    starts = placed.groupBy("shard", "part").agg(F.sum("copies").alias("rows")).select(
        "shard", "part", (F.sum("rows").over(before) - F.col("rows")).alias("start")
    )
    within = W.partitionBy("shard", "part").orderBy("place", "id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, 0)
    numbered = placed.withColumn("within", F.sum("copies").over(within) - F.col("copies")).join(starts, ["shard", "part"])
    # Copies of a row come out a thousand at a time, spread over the tasks.
    blocks = numbered.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _GROUP))))
    last = F.least(F.col("copies"), (F.col("block") + 1) * _GROUP) - 1
    copies = blocks.repartition("place", "block").withColumn("copy", F.explode(F.sequence(F.col("block") * _GROUP, last)))
    return copies.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard",
        (F.col("start") + F.col("within") + F.col("copy")).alias("slot"), "grown_shard",
    )


def moves(docs: DataFrame, n_shards: int, more_shards: int, id_col: str = "doc_id") -> DataFrame:
    """(from_shard, to_shard, n_rows) of a change from ``n_shards`` to any other number, counted in each task first."""
    rows = docs.select(F.col(id_col).alias("__key"))
    rows = with_jump(with_jump(rows, F.col("__key"), n_shards, "__a"), F.col("__key"), more_shards, "__b")
    return rows.groupBy(
        F.col("__a")["b"].cast("int").alias("from_shard"), F.col("__b")["b"].cast("int").alias("to_shard")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def write_shards(
    docs: DataFrame, dest: str, n_shards: int, files_per_shard: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """One folder ``shard=N`` per shard with about ``files_per_shard`` Parquet files; an id with many texts is spread over them."""
    placed = assign(docs, n_shards, id_col)
    salt = F.pmod(F.xxhash64(id_col, text_col), F.lit(files_per_shard))
    placed.drop("grown_shard").repartition(n_shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(dest)
