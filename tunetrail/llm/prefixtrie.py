"""The prefix trie of conversations, by truncation peeling.

1. Turns are numbered within their conversation and become digests.  Every conversation is rebuilt from a shared opening
   and its own later turns, and each of its prefixes gets a chained digest: the digest of the prefix before it and of the
   turn.  Equal prefixes have equal digests.  This table of prefixes is written once, in the order of their depth.
2. Peeling starts at the greatest depth.  The nodes of a depth are what survives from below, with their last turn stripped,
   regrouped with the conversations that end there.  One aggregate both finds the nodes and sums up their subtrees:
   smallest member, members, children, leaves, saved tokens.  A look at the prefix table tells a node's last turn and
   the key that it goes on under.  Each depth is checkpointed.
3. Where no conversation ends for several depths and no survivors merge, the survivors are single chains; these depths
   are peeled together.  So one very long conversation doesn't cost a step for each of its turns.

Copies of a conversation are one row per task after the partial aggregate, whatever their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed, compact, stored

FAMILY, HEADS = 20, 4
#: Ids of a piece whose text is hashed at once; rows of a partition of a peeled depth, about.
PIECE_IDS, ROWS = 5_000, 200_000

_ROOT = hashlib.sha256(b"").digest()
_NONE = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos from 1, digest, words) of every turn; ties of the turn number go by the digest."""
    src = conversations.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                               F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    rows = src.select("conv_id", "turn", digest.alias("digest"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return rows.select("conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")).alias("pos"), "digest", "words")


def _rebuilt(turns: DataFrame, family: int, heads: int) -> DataFrame:
    """(conv_id, d from 1, digest, words): the first turns of the family's first conversation, then the conversation's own after as many.

    A conversation with no turns left has one row, of depth 0."""
    openings = (turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads)).groupBy("conv_id")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("opening")))  # heads - 1 turns at most
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("length")).withColumn("h", own.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    led = (lengths.join(openings.withColumnRenamed("conv_id", "base"), "base", "left")
           .withColumn("opening", F.slice(F.coalesce("opening", F.array().cast("array<struct<pos:int,digest:binary,words:bigint>>")), F.lit(1), F.col("h"))))
    led = led.withColumn("lead", F.size("opening")).withColumn("left", F.greatest(F.col("length") - F.col("h"), F.lit(0)))
    first = led.select("conv_id", F.explode("opening").alias("x")).select("conv_id", F.col("x.pos").alias("d"), "x.digest", "x.words")
    rest = turns.join(led.select("conv_id", "h", "lead"), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("d"), "digest", "words")
    empty = led.where("lead + left = 0").select("conv_id", F.lit(0).alias("d"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return first.unionByName(rest).unionByName(empty)


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, d, key, parent, words, last): every prefix with its chained digest; ``last`` marks the whole conversation.

    A conversation's turns pass through a task in order; no more than a batch of them is held."""
    schema = pa.schema([("conv_id", pa.int64()), ("d", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()), ("words", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key = None, _ROOT
        for batch in it:
            keys, parents = [], []
            for c, d, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if c != conv:
                    conv, key = c, _ROOT
                parents.append(key if d else None)
                if d:
                    key = hashlib.sha256(key + digest).digest()
                keys.append(key)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(parents, pa.binary()), batch.column(3)], schema=schema)

    ordered = rebuilt.select("conv_id", F.col("d").cast("int").alias("d"), "digest", "words").repartition("conv_id").sortWithinPartitions("conv_id", "d")
    return ordered.mapInArrow(run, "conv_id long, d int, key binary, parent binary, words long")


def _ends_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end at a node, ascending.

    Ids are joined in pieces, in partitions by ranges of (key, id), so a node where a third of all conversations end is
    spread; the pieces of a node then pass through one hash in order, one at a time."""

    def pieces(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        key, ids = None, []
        out: list[dict] = []
        for batch in it:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) >= PIECE_IDS):
                    out.append({"key": key, "first": ids[0], "ids": ",".join(map(str, ids))})
                    ids = []
                key = k
                ids.append(c)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if ids:
            yield pa.RecordBatch.from_pylist([{"key": key, "first": ids[0], "ids": ",".join(map(str, ids))}], schema=schema)

    def digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
        key, sha = None, None
        for batch in it:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if sha is not None:
                        out.append({"key": key, "ends_sha256": sha.hexdigest()})
                    key, sha = k, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": sha.hexdigest()}], schema=schema)

    joined = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def _chains(nodes: DataFrame, prefixes: DataFrame, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """The chains above the nodes of depth ``high``, from depth high - 1 to ``low``: their nodes, and those of depth ``low`` alone."""
    up = Window.partitionBy("conv_id").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    src = nodes.select("conv_id", "n_convs", "n_leaves", F.col("saved_tokens").alias("below"))
    rows = (prefixes.where(F.col("d").between(low, high - 1)).join(src, "conv_id")
            .select("key", "parent", "conv_id", "d", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", (F.col("below") + F.sum((F.col("n_convs") - 1) * F.col("words")).over(up)).alias("saved_tokens")))
    rows = checkpointed(rows)
    return rows, rows.where(F.col("d") == low)


def prefix_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (long), ends_sha256.

    Conversation c opens with the first h turns of conversation c - c % ``family`` (h = crc32 of c as text, mod
    ``heads``), all if it has fewer and none if there is no such conversation; its own turns after its first h follow.
    Turns go by number, nulls first; equal numbers by the SHA-256 of their role's length, role and text; repeated rows are
    turns of their own.  A null role or text is empty.  Rows with a null conv_id are left out: they belong to
    no conversation.  A conversation whose turns are all gone ends at the root.  No rows give no nodes.
    """
    prefixes = stored(_prefixes(_rebuilt(checkpointed(_turns(conversations, conv_col, turn_col, role_col, text_col)), family, heads)).repartitionByRange("d", "conv_id").sortWithinPartitions("d", "conv_id"))
    lasts = prefixes.groupBy("conv_id").agg(F.max("d").alias("d"))
    ends = checkpointed(prefixes.join(lasts, ["conv_id", "d"]).select("key", "conv_id", "d"))
    # distinct lengths: their number grows with the square root of the turns at most
    depths = sorted((r.d for r in ends.select("d").distinct().collect()), reverse=True)
    if not depths:
        return _empty(conversations)
    found: list[DataFrame] = []
    nodes: DataFrame | None = None  # of the depth last peeled
    depth = depths[0] + 1
    while depth > 0:
        lower = [d for d in depths if d < depth]
        end = lower[0] if lower else 0
        if nodes is not None and depth - end > 2:
            alive = nodes.count()
            low = end + 1
            while low < depth - 1 and prefixes.where(F.col("d") == low).join(nodes.select("conv_id"), "conv_id").select("key").distinct().count() < alive:
                low = (low + depth) // 2
            if low < depth - 1:
                rows, nodes = _chains(nodes, prefixes, low, depth)
                found.append(rows)
                depth = low
        depth -= 1
        one = F.lit(1).cast("long")
        ended = ends.where(F.col("d") == depth).select("key", "conv_id", one.alias("n_convs"), F.lit(0).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
        if nodes is not None:
            ended = ended.unionByName(nodes.select(F.col("parent").alias("key"), "conv_id", "n_convs", one.alias("n_children"), "n_leaves", "saved_tokens"))
        group = ended.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
        group = group.withColumn("n_leaves", F.when(F.col("n_children") == 0, one).otherwise(F.col("n_leaves")))
        if depth:
            at = prefixes.where(F.col("d") == depth).select("conv_id", "parent", "words")
            group = group.join(at, "conv_id").withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
        else:
            group = group.withColumn("parent", F.lit(None).cast("binary"))
        nodes = compact(checkpointed(group.select("key", "parent", "conv_id", F.lit(depth).alias("d"), "n_convs", "n_children", "n_leaves", "saved_tokens")), ROWS)
        found.append(nodes)
    trie = found[0]
    for more in found[1:]:
        trie = trie.unionByName(more)
    parents = trie.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (trie.join(parents, "parent", "left").join(_ends_digests(ends), "key", "left")
            .select("conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")))


def _empty(conversations: DataFrame) -> DataFrame:
    longs = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return conversations.sparkSession.createDataFrame([], longs)
