"""The trie of all conversation prefixes, screened by a count-min sketch of prefix digests.

A prefix is known by its digest, a running polynomial over its turns; no text is shuffled. Every
prefix is counted in a count-min sketch. An estimate of one is an upper bound, so it proves that
no other conversation has the prefix: the nodes of such tails are written out where they are, with their one
member, one leaf and nothing saved. Only prefixes the sketch cannot rule out are shuffled and
grouped exactly. A sketch that is too small for its input costs more grouping, never a wrong node.

Positions and digests run along range-partitioned rows, with one carry per partition, so a very long
conversation spreads over tasks. Sums over subtrees of the shared nodes climb by doubled
pointers: a round per power of two of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterflow.llm.shared import staged
from meterflow.operators.skew import materialise

GROUP = 20  # a conversation starts with turns of the first of its group of ids
HEADS = 4
PRIME = (1 << 127) - 1
BASE = 0x5851F42D4C957F2D14057B7EF767814F
UNBASE = [pow(BASE, -n, PRIME) for n in range(HEADS)]
LOW = (1 << 64) - 1
# Cells of one row of the sketch: two bits of state each while counted, one on the driver and in the tasks.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 27
RUN = 4096
WORDS = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()

ROW = "conv_id long, depth long, turns long, kh long, kl long, ph long, pl long, words long"


def _number(high: int, low: int) -> int:
    return high << 64 | low & LOW


def _halves(number: int) -> tuple[int, int]:
    low = number & LOW
    return number >> 64, low - (1 << 64) if low >> 63 else low


# ---- rebuilt conversations -------------------------------------------------------------------

def _turns(conversations: DataFrame) -> DataFrame:
    """Digest and words of each turn; null role and text are empty, rows without conv_id are none."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.xxhash64(F.lit(1), role, text).alias("d1"),
        F.xxhash64(F.lit(2), role, text).alias("d2"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("part", "conv_id", "d1", "d2", "words")))


def _walk(rows: Iterator[tuple], carried: dict[int, tuple]) -> Iterator[tuple]:
    """Each turn with its position in its conversation and the running polynomial before and with it."""
    at = None
    for part, conv, d1, d2, words in rows:
        if conv != at:
            before = carried.get(part, (None,))
            position, total, power = before[1:] if at is None and before[0] == conv else (0, 0, 1)
            at = conv
        position, power, last = position + 1, power * BASE % PRIME, total
        total = (total + ((d1 & LOW) << 63 ^ d2 & LOW) * power) % PRIME
        yield part, conv, position, words, last, total, power


def _numbered(turns: DataFrame) -> DataFrame:
    """``position`` and running digest (``rh``, ``rl``) of every turn, and the one before it (``qh``, ``ql``)."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "d1", "d2"]
    placed = materialise(
        materialise(turns).repartitionByRange(*order).sortWithinPartitions(*order)).withColumn(
        "part", F.spark_partition_id().cast("long"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for last in _walk(_runs(batches), {}):
            first = first if first is not None else last[1]
        if last is not None:
            part, conv, position, _, _, total, power = last
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (part, first, conv, position, *_halves(total), *_halves(power))],
                names=["part", "first", "conv", "n", "th", "tl", "bh", "bl"])

    found = placed.select("part", "conv_id", "d1", "d2", "words").mapInArrow(
        ends, "part long, first long, conv long, n long, th long, tl long, bh long, bl long")
    carried, open_ = {}, (None, 0, 0, 1)
    for row in sorted(found.collect()):  # one row per partition
        carried[row.part] = open_
        n, total, power = row.n, _number(row.th, row.tl), _number(row.bh, row.bl)
        if row.first == row.conv == open_[0]:
            n, total, power = open_[1] + n, (open_[2] + open_[3] * total) % PRIME, open_[3] * power % PRIME
        open_ = (row.conv, n, total, power)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walked = _walk(_runs(batches), carried)
        for rows in _chunks((conv, position, words, *_halves(total), *_halves(last))
                            for _, conv, position, words, last, total, _ in walked):
            yield _batch(rows, ["conv_id", "position", "words", "rh", "rl", "qh", "ql"])

    return staged(placed.select("part", "conv_id", "d1", "d2", "words").mapInArrow(
        number, "conv_id long, position long, words long, rh long, rl long, qh long, ql long"), "numbered")


def _chunks(rows: Iterator[tuple], size: int = 10_000) -> Iterator[list[tuple]]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names=names)


def _heads(numbered: DataFrame) -> DataFrame:
    """One row per conversation: its length, how many turns it takes over (``h``), digests and words of its
    own first three turns, and those of the conversation it takes them from (``b`` columns)."""
    own = numbered.groupBy("conv_id").agg(F.max("position").alias("n"), *[
        F.max(F.when(F.col("position") == p, F.col(name))).alias(f"{name}{p}")
        for p in range(1, HEADS) for name in ("rh", "rl", "words")])
    own = staged(own.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS,
        "base_id": F.col("conv_id") - F.col("conv_id") % GROUP}), "own")
    base = own.where("conv_id = base_id").select(
        "base_id", *[F.col(name).alias(f"b{name}") for name in own.columns if name not in ("conv_id", "base_id", "h")])
    taken = F.least("h", F.coalesce("bn", F.lit(0)))
    return staged(own.join(base, "base_id", "left").withColumn("taken", taken).withColumn(
        "turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "heads")


def _at(prefix: str, place: str) -> Column:
    """Value of a numbered head column at a place, zero at place 0."""
    chain = F.lit(0).cast("long")
    for p in range(1, HEADS):
        chain = F.when(F.col(place) == p, F.col(f"{prefix}{p}")).otherwise(chain)
    return chain


def _prefixes(numbered: DataFrame, heads: DataFrame) -> DataFrame:
    """A row per conversation and prefix of one turn or more: digest, parent's digest, last turn's words."""
    taken = heads.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))).alias("depth"),
                         ).where("taken > 0").withColumn("above", F.col("depth") - 1).select(
        "conv_id", "depth", "turns", _at("brh", "depth").alias("kh"), _at("brl", "depth").alias("kl"),
        _at("brh", "above").alias("ph"), _at("brl", "above").alias("pl"), _at("bwords", "depth").alias("words"))
    lead = heads.where("turns > taken").select(
        "conv_id", "h", "taken", "turns", _at("brh", "taken").alias("bh"), _at("brl", "taken").alias("bl"),
        _at("rh", "h").alias("sh"), _at("rl", "h").alias("sl"))
    own = numbered.join(lead, "conv_id").where(F.col("position") > F.col("h"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "words", "rh", "rl", "qh", "ql", "h", "taken", "turns", "bh", "bl", "sh", "sl"]
        for batch in batches:
            rows = []
            for conv, p, words, rh, rl, qh, ql, h, kept, turns, bh, bl, sh, sl in zip(
                    *(batch.column(c).to_pylist() for c in names)):
                begin, skipped, shift = _number(bh, bl), _number(sh, sl), UNBASE[h - kept]
                key, above = (
                    (begin + (_number(*r) - skipped) * shift) % PRIME for r in ((rh, rl), (qh, ql)))
                rows.append((conv, kept + p - h, turns, *_halves(key), *_halves(above), words))
            if rows:
                yield _batch(rows, ROW.replace(" long", "").split(", "))

    return staged(taken.unionByName(own.mapInArrow(join, ROW)), "prefixes")


# ---- screening -------------------------------------------------------------------------------

def _cells(count: int) -> int:
    """Cells of a sketch row: four for each prefix, within bounds."""
    return min(max(LEAST_CELLS, 1 << (4 * count).bit_length()), MOST_CELLS)


def _sketch_cells(high: Column, low: Column, cells: int) -> list[Column]:
    return [F.xxhash64(F.lit(row), high, low).bitwiseAND(F.lit(cells - 1)) for row in (0, 1)]


def _screen(prefixes: DataFrame, cells: int) -> list[np.ndarray]:
    """Count-min sketch of the prefixes, as one bit per cell: whether more than one was counted."""
    spark = prefixes.sparkSession
    each = prefixes.select(F.explode(F.array(*[
        F.struct(F.lit(row).alias("row"), cell.alias("cell"))
        for row, cell in enumerate(_sketch_cells(F.col("kh"), F.col("kl"), cells))])).alias("at")).select("at.*")
    # A cell that is counted twice needs no higher count.
    crowded = each.groupBy("row", "cell").agg(F.count("*").alias("n")).where("n > 1")
    maps = crowded.groupBy("row", F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    rows = [np.zeros(cells // 8 + 2 * 4096, np.uint8) for _ in range(2)]
    for row in maps.toLocalIterator():  # cells / 8 bytes a row in all
        bits = np.frombuffer(row.bits, np.uint8)
        # Bucket 1 holds the bits of 1 to 32768, bucket 0 that of zero and below.
        start = row.bucket * 4096
        rows[row.row][start: start + len(bits)] = bits
    return rows


def _judged(prefixes: DataFrame, cells: int) -> DataFrame:
    """``shared`` and ``parent_shared``: whether the estimate leaves room for another conversation."""
    known = prefixes.sparkSession.sparkContext.broadcast(_screen(prefixes, cells))

    @F.pandas_udf("boolean")
    def several(first: pd.Series, second: pd.Series) -> pd.Series:
        both = True
        for bits, cell in zip(known.value, (first, second)):
            cell = cell.to_numpy()
            # As in bitmap_bucket_number: cell c is bit (c - 1) mod 32768 of its bucket, zero is bit 0 of bucket 0.
            place = np.where(cell > 0, cell - 1 + 32768, 0)
            both = both & (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return pd.Series(both)

    return staged(prefixes.withColumns({
        "shared": several(*_sketch_cells(F.col("kh"), F.col("kl"), cells)),
        "parent_shared": (F.col("depth") == 1) | several(*_sketch_cells(F.col("ph"), F.col("pl"), cells))}), "judged")


# ---- shared nodes ----------------------------------------------------------------------------

def _ends(members: DataFrame) -> DataFrame:
    """``ends_sha256`` per node of its members' ids in rising order.

    Ids are sorted across partitions and joined into runs there; only runs, a few thousand ids each,
    meet in the task that hashes a node, one after the other.
    """
    names = ["kh", "kl", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple, ids: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*key, ids[0], ",".join(map(str, ids)))], names=["kh", "kl", "first", "ids"])

        key, ids = None, []
        for batch in batches:
            for kh, kl, conv in zip(*(batch.column(c).to_pylist() for c in names)):
                if (kh, kl) != key or len(ids) == RUN:
                    if ids:
                        yield out(key, ids)
                    key, ids = (kh, kl), []
                ids.append(conv)
        if ids:
            yield out(key, ids)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for kh, kl, ids in zip(*(batch.column(c).to_pylist() for c in ("kh", "kl", "ids"))):
                if (kh, kl) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (kh, kl), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield finished(done)
                done = []
        if key is not None:
            yield finished([(*key, digest.hexdigest())])

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["kh", "kl", "ends_sha256"])

    runs = members.select(*names).repartitionByRange(*names).sortWithinPartitions(*names).mapInArrow(
        joined, "kh long, kl long, first long, ids string")
    return runs.repartition("kh", "kl").sortWithinPartitions("kh", "kl", "first").mapInArrow(
        hashed, "kh long, kl long, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``kh``, ``kl``, ``n_leaves`` and ``saved_tokens`` summed over each node's subtree.

    After round r a node has the sums of all nodes less than 2^r below it and points 2^r up.
    """
    sums = ["n_leaves", "saved_tokens"]
    now = staged(nodes.select("kh", "kl", F.col("ph").alias("ah"), F.col("pl").alias("al"), *sums), "sums")
    while not now.where("ah IS NOT NULL").isEmpty():
        given = now.where("ah IS NOT NULL").groupBy(F.col("ah").alias("kh"), F.col("al").alias("kl")).agg(
            *[F.sum(name).alias(f"more_{name}") for name in sums])
        above = now.select(F.col("kh").alias("ah"), F.col("kl").alias("al"), F.col("ah").alias("xh"), F.col("al").alias("xl"))
        now = staged(
            now.join(above, ["ah", "al"], "left").join(given, ["kh", "kl"], "left").select(
                "kh", "kl", F.col("xh").alias("ah"), F.col("xl").alias("al"),
                *[(F.col(name) + F.coalesce(f"more_{name}", F.lit(0))).alias(name) for name in sums]), "sums")
    return now.select("kh", "kl", *sums)


def nodes(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Turns order by ``turn``, null first, equal ones by a
    digest of role and text, so repeated rows are repeated turns. Null role or text counts as empty. Rows without
    conv_id belong to no conversation. No rows give no nodes. Other columns are not read.
    """
    numbered = _numbered(_turns(conversations))
    heads = _heads(numbered)
    prefixes = _prefixes(numbered, heads)
    smallest, n_convs = heads.agg(F.min("conv_id"), F.count("*")).first()
    spark = conversations.sparkSession
    if not n_convs:
        return spark.createDataFrame([], (
            "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, ends_sha256 string"))
    judged = _judged(prefixes, _cells(prefixes.count()))
    tails, inner = judged.where("NOT shared"), judged.where("shared")
    tops = tails.where("parent_shared").groupBy("ph", "pl").agg(F.count("*").alias("tops"))
    grouped = staged(inner.groupBy("kh", "kl").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"),
        F.first("ph").alias("ph"), F.first("pl").alias("pl"), F.first("words").alias("words")), "nodes")
    below = staged(grouped.groupBy("ph", "pl").agg(F.count("*").alias("branches")).join(
        tops, ["ph", "pl"], "full").select(
        F.col("ph").alias("kh"), F.col("pl").alias("kl"), F.coalesce("branches", F.lit(0)).alias("branches"),
        F.coalesce("tops", F.lit(0)).alias("tops")), "below")
    ended = inner.where("depth = turns").select("kh", "kl", "conv_id").union(
        heads.where("turns = 0").select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id"))
    ends = staged(_ends(ended), "ends")
    own = staged(grouped.join(below, ["kh", "kl"], "left").select(
        "kh", "kl", "ph", "pl", "conv_id", "depth", "n_convs",
        F.coalesce(F.col("branches") + F.col("tops"), F.lit(0)).alias("n_children"),
        F.coalesce("tops", F.when(F.col("branches").isNull(), 1)).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "own")
    sums = _subtree_sums(own.withColumns({
        "ph": F.when(F.col("depth") > 1, F.col("ph")), "pl": F.when(F.col("depth") > 1, F.col("pl"))}))
    whole = staged(own.drop("n_leaves", "saved_tokens").join(sums, ["kh", "kl"]).join(
        ends, ["kh", "kl"], "left"), "shared")
    parents = own.select(F.col("kh").alias("ph"), F.col("kl").alias("pl"), F.col("conv_id").alias("_parent"))
    root_key = (F.col("kh") == 0) & (F.col("kl") == 0)

    def out(rows: DataFrame, parent: Column, **columns: Column) -> DataFrame:
        # A parent that is no shared node has this one member.
        return rows.select("conv_id", "depth", parent.alias("parent_conv_id"), *[
            columns.get(name, F.col(name)).cast("long").alias(name)
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.coalesce(
            columns.get("ends", F.col("ends_sha256") if "ends_sha256" in rows.columns else F.lit(None)),
            F.lit(NOTHING)).alias("ends_sha256"))

    deep = F.col("depth") > 1
    shared_rows = out(
        whole.join(parents, ["ph", "pl"], "left"),
        F.when(deep, F.coalesce("_parent", "conv_id")).otherwise(F.lit(smallest)))
    tail = dict(
        n_convs=F.lit(1), n_children=(F.col("depth") < F.col("turns")).cast("long"), n_leaves=F.lit(1),
        saved_tokens=F.lit(0), ends=F.when(
            F.col("depth") == F.col("turns"), F.sha2(F.col("conv_id").cast("string"), 256)))
    local_rows = out(tails.where(~F.col("parent_shared")), F.col("conv_id"), **tail).union(
        out(tails.where((F.col("depth") == 1)), F.lit(smallest), **tail)).union(
        out(tails.where(F.col("parent_shared") & deep).join(parents, ["ph", "pl"]), F.col("_parent"), **tail))
    # The root: sums over the nodes of depth one, and the first nodes of tails there.
    first = whole.where("depth = 1").agg(
        F.count("*"), F.coalesce(F.sum("n_leaves"), F.lit(0)), F.coalesce(F.sum("saved_tokens"), F.lit(0))).first()
    alone = tails.where("depth = 1").count()
    digest = ends.where(root_key).first()
    children = first[0] + alone
    root = spark.createDataFrame(
        [(smallest, 0, None, n_convs, children, first[1] + alone if children else 1, first[2],
          digest.ends_sha256 if digest else NOTHING)], shared_rows.schema)
    return root.union(shared_rows).union(local_rows)
