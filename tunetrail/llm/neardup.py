"""Near-duplicate groups by a signature-coordinate inverted join.

1. Every document becomes its set of word shingles, as 64-bit hashes, and a MinHash signature.  Documents with equal
   sets are one class, so copies are never expanded into pairs.
2. Each class is posted under its coordinate-value pairs.  Two classes that agree in ``matches`` of the coordinates
   or more agree in one of the rarest ones of either (prefix rule), so all but ``matches - 1`` of a class's
   coordinates are posted, rarest first; values that only one class has take up places first and need no list.  What
   many documents share, such as a common passage, has the longest lists and is skipped.
3. In each list the classes are compared with a pivot, the class whose values are the most common (the original of a
   group of copies).  Pairs whose sketches agree in ``close`` bytes are confirmed on their full sets.
4. Confirmed links give components.  A list whose classes are then all in one component is done.  In any other, the
   classes outside its largest component are compared with the rest, in blocks inside tasks: first by sketches alone,
   which tells the classes that have a close partner in another component; then these, on full sets, in blocks bounded by
   the bytes of the sets.  Lists with the same largest component are taken together, so classes that share many lists
   meet once.  A block returns links that join components, not all pairs, so no link between components is lost and no
   group's pairs are written out.

Misses: a pair of similarity s is compared unless it agrees in fewer than ``matches`` of ``hashes`` coordinates, or its
sketches in fewer than ``close`` of SKETCH bytes; for s = 0.8 that is one pair in five million and one in fifty
million, and far fewer above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import batches, checkpointed, compact
from tunetrail.llm.components import connected_components

SHINGLE, SIMILARITY = 4, 80
HASHES, MATCHES = 32, 13
#: Bytes of a sketch, each of a further MinHash coordinate, and how many must agree.
SKETCH, CLOSE = 192, 121
#: What a block holds, about: of the classes outside the largest component, of those that they are compared with, of a
#: list that shares its block with others, and of such a shared block.  By classes for sketches, by bytes for full sets.
CLASSES, BYTES = (2048, 8192, 64, 4096), (8 << 20, 24 << 20, 1 << 20, 8 << 20)
#: Rows of a partition, about, of the tables of postings and links, and of full sets.
ROWS, SET_ROWS = 50_000, 2_000
#: Slots of the filter that tells which documents' full sets are needed, for each of them, and at most (256 MB).  Beyond
#: 2**27 needed documents it lets more of the others through, which the join then drops.
SLOTS_EACH, MOST_SLOTS = 16, 1 << 31

_UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.random.default_rng(20240607).integers(1, 1 << 63, size=(2, 512), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a UTF-8 text: A-Z in lower case, words between ASCII
    white space; a text of fewer words is one shingle, one without words has none."""
    w = text.translate(_UPPER).split() if text else []
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    n = min(n, len(w))
    out = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(w) - n + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray, hashes: int = HASHES) -> list[int]:
    """The least value of each of ``hashes`` mixings of the shingles, as signed 64-bit integers."""
    out = np.empty(hashes, dtype=np.uint64)
    for j in range(hashes):
        v = (shingles ^ _MIX[0, j]) * _MIX[1, j]
        out[j] = (v ^ (v >> np.uint64(29))).min()
    return out.view(np.int64).tolist()


def sketch(shingles: np.ndarray) -> bytes:
    """The last bytes of SKETCH further MinHash coordinates."""
    out = np.empty(SKETCH, dtype=np.uint8)
    for j in range(SKETCH):
        v = (shingles ^ _MIX[0, -1 - j]) * _MIX[1, -1 - j]
        out[j] = int((v ^ (v >> np.uint64(29))).min()) * 0x9E3779B97F4A7C15 >> 40 & 255
    return out.tobytes()


def _node(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(docs: DataFrame, shingle: int = SHINGLE, hashes: int = HASHES, id_col: str = "doc_id", text_col: str = "text", row_key: Column | None = None) -> DataFrame:
    """id, node (128-bit digest of the shingle set; null if empty), n_shingles, sig, and row_key (null if none is given)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("binary").alias("_text"), (F.lit(None) if row_key is None else row_key).cast("string").alias("_key"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            schema = pa.schema([batch.schema.field(0).with_name(id_col), ("node", pa.binary()), ("n_shingles", pa.int64()), ("sig", pa.list_(pa.int64())), ("row_key", pa.string())])

            def rows(batch=batch):
                for doc, text, key in zip(batch.column(0), batch.column(1), batch.column(2)):
                    s = shingle_set(text.as_py(), shingle)
                    yield doc.as_py(), _node(s), len(s), signature(s, hashes) if len(s) else None, key.as_py()

            yield from batches(rows(), schema)

    return src.mapInArrow(run, f"{id_col} {id_type}, node binary, n_shingles long, sig array<long>, row_key string")


def _filter_bits(needed: DataFrame, slots: int) -> np.ndarray:
    """Bit s is set if a needed document's id falls in slot s: ``slots`` / 8 bytes."""
    # bitmaps of 4096 bytes are numbered from 1, for values from 1
    bits = (needed.select((_slot(F.col("doc"), slots) + 1).alias("s")).groupBy(F.expr("bitmap_bucket_number(s)").alias("k"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("bits")))
    out = np.zeros(slots // 8, dtype=np.uint8)
    for r in bits.toLocalIterator():
        part = np.frombuffer(r["bits"], dtype=np.uint8)
        begin = (r["k"] - 1) * len(part)
        out[begin:begin + len(part)] = part[:len(out) - begin]
    return out


def _slot(c: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(slots))


def _full_sets(docs: DataFrame, needed: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles, sketch) of the nodes in ``needed`` (node, doc).  Bits of the hashed ids spare the other
    documents; the texts aren't shuffled."""
    slots = min(MOST_SLOTS, max(1 << 16, 1 << (SLOTS_EACH * needed.count()).bit_length()))
    bits = _filter_bits(needed, slots)
    src = docs.select(_slot(F.col(f"`{id_col}`"), slots).alias("slot"), F.col(f"`{text_col}`").cast("binary"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64())), ("sketch", pa.binary())])
        for batch in it:
            slot = batch.column(0).to_numpy()
            batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7) & 1).astype(bool)))

            def rows(batch=batch):
                for text in batch.column(1):
                    s = shingle_set(text.as_py(), shingle)
                    if len(s):
                        yield _node(s), s.view(np.int64), sketch(s)

            yield from batches(rows(), schema, 200)

    found = src.mapInArrow(run, "node binary, shingles array<long>, sketch binary")
    return found.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _postings(nodes: DataFrame, matches: int) -> DataFrame:
    """(j, v, node, weight): the coordinate-value pairs under which a node is posted, rarest first; weight is how common its values are."""
    each = nodes.select("node", F.posexplode("sig").alias("j", "v"))
    shared = each.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = each.join(shared, ["j", "v"]).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "j", "v"))).alias("all"))  # as many as hashes at most
    return (kept.where(F.size("all") >= matches)
            .select("node", F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("weight"), F.explode(F.slice("all", F.lit(1), F.size("all") - (matches - 1))).alias("x"))
            .select(F.col("x.j").alias("j"), F.col("x.v").alias("v"), "node", "weight"))


def _star_pairs(postings: DataFrame) -> DataFrame:
    """Each posted node with the pivot of its list."""
    pivot = postings.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("weight", "node"))["node"].alias("pivot")).where("n > 1").select("j", "v", "pivot")
    return postings.join(pivot, ["j", "v"]).where(F.col("node") != F.col("pivot")).select("j", "v", "node", "pivot")


def _open_lists(postings: DataFrame, pivots: DataFrame, roots: DataFrame) -> DataFrame:
    """(major, node, label) of the lists that, without their pivots, hold classes of more than one component: each list
    stands under its largest component, and a class once under each of these."""
    left = postings.join(pivots, ["j", "v", "node"], "left_anti").join(roots.withColumnRenamed("root", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    size = left.groupBy("j", "v", "label").agg(F.count(F.lit(1)).alias("n"))
    lists = (size.groupBy("j", "v").agg(F.max(F.struct("n", "label"))["label"].alias("major"), F.count(F.lit(1)).alias("labels"))
             .where("labels > 1").select("j", "v", "major"))
    return left.join(lists, ["j", "v"]).select("major", "node", "label").distinct()


def _agreeing(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (sketches == one).sum(axis=1)


def _bytes_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)


def _close_pairs(pairs: DataFrame, sketches: DataFrame, close: int) -> DataFrame:
    """The pairs (node, pivot) whose sketches agree."""
    both = pairs.join(sketches, "node").join(sketches.toDF("pivot", "pivot_sketch"), "pivot").select("node", "pivot", "sketch", "pivot_sketch")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = _agreeing(_bytes_matrix(batch.column(2)), _bytes_matrix(batch.column(3))) >= close
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.mapInArrow(run, "node binary, pivot binary")


def _blocks(rows: DataFrame, weight: Column, bounds: tuple[int, int, int, int], columns: list[str]) -> tuple:
    """The lists (major, node, label, ...) cut into blocks (g, a, b): in each, classes outside the largest component on the
    left, and what they are compared with on the right.  ``bounds`` are sums of ``weight``; see CLASSES and BYTES."""
    few, many, short, shared = bounds
    weighed = rows.withColumn("w", weight.cast("long"))
    size = weighed.groupBy("major").agg(F.sum("w").alias("all"), F.coalesce(F.sum(F.when(F.col("label") != F.col("major"), F.col("w"))), F.lit(0)).alias("minor"))
    together = max(1, (size.where(F.col("all") <= short).agg(F.sum("all")).first()[0] or 0) // shared)
    parts = lambda n, of: F.greatest(F.lit(1), F.ceil(F.col(n) / of)).cast("int")
    group = F.when(F.col("all") <= short, F.pmod(F.xxhash64("major"), F.lit(together))).otherwise(F.xxhash64("major"))
    dealt = weighed.join(size, "major").select("major", "node", "label", *columns, group.alias("g"), parts("minor", few).alias("few"), parts("all", many).alias("many"))
    part = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    names = ["g", "a", "b", "major", "node", "label", *columns]
    left = dealt.where("label != major").withColumn("a", part(F.col("few"))).withColumn("b", every(F.col("many"))).select(names)
    right = dealt.withColumn("b", part(F.col("many"))).withColumn("a", every(F.col("few"))).select(names).toDF(*[f"r_{n}" for n in names])
    return left.groupBy("g", "a", "b").cogroup(right.groupBy("r_g", "r_a", "r_b"))


def _places(keys: list) -> dict[bytes, np.ndarray]:
    at: dict[bytes, list[int]] = {}
    for i, key in enumerate(keys):
        at.setdefault(key, []).append(i)
    return {key: np.array(i) for key, i in at.items()}


def _with_partners(lists: DataFrame, sketches: DataFrame, close: int) -> DataFrame:
    """The rows of ``lists`` whose class has one of another component in its list whose sketch agrees."""

    def compare(minor: pa.Table, others: pa.Table) -> pa.Table:
        out: dict[str, list] = {"major": [], "node": []}
        if minor.num_rows and others.num_rows:
            nodes, labels, sketches = others.column("r_node").to_pylist(), np.array(others.column("r_label").to_pylist(), dtype=object), _bytes_matrix(others.column("r_sketch"))
            places, some = _places(others.column("r_major").to_pylist()), np.zeros(others.num_rows, dtype=bool)
            for major, node, label, one in zip(minor.column("major").to_pylist(), minor.column("node").to_pylist(), minor.column("label").to_pylist(), _bytes_matrix(minor.column("sketch"))):
                k = places.get(major)
                if k is not None:
                    k = k[(_agreeing(sketches[k], one) >= close) & (labels[k] != label)]
                    some[k] = True
                    if len(k):
                        out["major"].append(major)
                        out["node"].append(node)
            majors = others.column("r_major").to_pylist()
            for i in np.flatnonzero(some):
                out["major"].append(majors[i])
                out["node"].append(nodes[i])
        return pa.table({k: pa.array(v, pa.binary()) for k, v in out.items()})

    found = _blocks(lists.join(sketches, "node"), F.lit(1), CLASSES, ["sketch"]).applyInArrow(compare, "major binary, node binary").distinct()
    return lists.join(found, ["major", "node"])


def _listed_links(lists: DataFrame, sets: DataFrame, close: int, similarity: int) -> DataFrame:
    """(a, b): links between components of the open lists, enough to join all that any of their links joins."""
    some = compact(checkpointed(_with_partners(lists, sets.select("node", "sketch"), close)), ROWS)
    rows = some.join(sets, "node")
    blocks = _blocks(rows, 8 * F.size("shingles") + 512, BYTES, ["sketch", "shingles"])

    def compare(minor: pa.Table, others: pa.Table) -> pa.Table:
        found: tuple[list, list] = ([], [])
        if minor.num_rows and others.num_rows:
            nodes, sketches, sets = others.column("r_node").to_pylist(), _bytes_matrix(others.column("r_sketch")), others.column("r_shingles").combine_chunks()
            own = minor.column("shingles").combine_chunks()
            up: dict[bytes, bytes] = {}

            def top(x: bytes) -> bytes:
                while up.setdefault(x, x) != x:
                    x = up[x] = up[up[x]]
                return x

            labels = others.column("r_label").to_pylist()
            places = _places(others.column("r_major").to_pylist())
            for m, (major, node, label, one) in enumerate(zip(minor.column("major").to_pylist(), minor.column("node").to_pylist(), minor.column("label").to_pylist(), _bytes_matrix(minor.column("sketch")))):
                k = places.get(major)
                if k is None:
                    continue
                agree, mine = _agreeing(sketches[k], one), None
                k = k[agree >= close][np.argsort(-agree[agree >= close], kind="stable")]  # the likeliest first
                for i in k:
                    x, y = top(label), top(labels[i])
                    if x == y:
                        continue
                    mine = _values(own, m) if mine is None else mine
                    theirs = _values(sets, i)
                    if _linked(mine, theirs, similarity):
                        up[x] = y
                        found[0].append(node)
                        found[1].append(nodes[i])
        return pa.table({"a": pa.array(found[0], pa.binary()), "b": pa.array(found[1], pa.binary())})

    return blocks.applyInArrow(compare, "a binary, b binary")


def _linked(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    """Whether two sets are alike enough; both are sorted as unsigned integers."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < similarity * len(b):  # even if one held the other
        return False
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= similarity * (len(a) + len(b) - common)


def _values(lists: pa.ListArray, i: int) -> np.ndarray:
    return lists.values[lists.offsets[int(i)].as_py():lists.offsets[int(i) + 1].as_py()].to_numpy().view(np.uint64)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after the components in ``roots`` are joined by new links; only their roots are linked anew."""
    of = roots.toDF("a", "root_a")
    ends = links.join(of, "a", "left").join(roots.toDF("b", "root_b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    merged = connected_components(ends)
    moved = roots.join(merged.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return compact(checkpointed(moved.union(merged.join(roots, "node", "left_anti"))), ROWS)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, hashes: int = HASHES, matches: int = MATCHES, close: int = CLOSE,
                    id_col: str = "doc_id", text_col: str = "text", row_key: Column | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (least id reachable by links), kept (id = component_id), and
    row_key if an expression for one is given.

    Documents are linked if their shingle sets' Jaccard similarity is ``similarity`` per cent or more.  A null, empty
    or blank text has no shingles and no links, and is kept.  Rows that repeat an id each give a row; a null id takes
    part but is never a component's id, unless all its ids are null (such rows are kept).  No rows give no rows.
    """
    rows = checkpointed(signatures(docs, shingle, hashes, id_col, text_col, row_key).withColumnRenamed(id_col, "doc"))
    nodes = checkpointed(rows.where("node is not null").groupBy("node").agg(F.min("doc").alias("doc"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig")))
    postings = compact(checkpointed(_postings(nodes, matches)), ROWS)
    sets = compact(checkpointed(_full_sets(docs, postings.select("node").distinct().join(nodes.select("node", "doc"), "node"), shingle, id_col, text_col)), SET_ROWS)
    sketches, shingles = sets.select("node", "sketch"), sets.select("node", "shingles")
    common = F.size(F.array_intersect("shingles", "pivot_shingles"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """(a, b) of the pairs (node, pivot) that are linked by their full sets."""
        both = pairs.join(shingles, "node").join(shingles.toDF("pivot", "pivot_shingles"), "pivot")
        return compact(checkpointed(both.where(100 * common >= similarity * (F.size("shingles") + F.size("pivot_shingles") - common)).select(F.col("node").alias("a"), F.col("pivot").alias("b"))), ROWS)

    star = compact(checkpointed(_star_pairs(postings)), ROWS)
    roots = connected_components(confirmed(_close_pairs(star.select("node", "pivot").distinct(), sketches, close)))
    lists = compact(checkpointed(_open_lists(postings, star.select("j", "v", F.col("pivot").alias("node")).distinct(), roots)), ROWS)
    roots = _joined(roots, compact(checkpointed(_listed_links(lists, sets, close, similarity)), ROWS))

    named = nodes.select("node", "doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    of = named.join(least, "root").select("node", "component_id")
    return (rows.join(of, "node", "left")
            .select(F.col("doc").alias(id_col), "n_shingles", F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"), *([] if row_key is None else ["row_key"]))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
