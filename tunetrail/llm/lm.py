"""Language-model scores by Katz backoff with Good-Turing discounts.

1. The corpus is coded once, in blocks of some megabytes of text: the hashes of a block's words, and its tokens as
   numbers into them.  The blocks are written; all later steps name a block by its number.
2. Counting.  For each order n, a block sends its distinct n-grams, as 64-bit hashes with their counts in training
   documents, to the tables of counts, which are partitioned by ranges of the hash.  A partition sums the counts of
   equal n-grams and keeps, for each block, the totals of what it asked for; one block owns each n-gram.  An n-gram that
   fills a third of the corpus is one entry per block.  Counts of counts are sums over the partitions.
3. Probabilities.  A seen n-gram of count r after a context of count C has d(r) r / C, d being Good-Turing's discount up
   to K; larger counts give up only TRUSTED of a count, so every context keeps some mass.  The owner of an n-gram
   adds what the discount leaves, and the lower-order probability of the last word, to the sums of its context.  The
   backoff weight is left / (1 - sum of lower-order probabilities of the seen words): each context's probabilities sum to one.
4. Tokens are evaluated order by order: the longest seen n-gram's probability, times the weights of the seen contexts
   that were left on the way.  Tokens of training documents are always seen; the rest join the table of weights, one
   row per block and context.

A word not seen in training has the mass that the unigrams' discounts leave.  Tables hold every n-gram of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed, stored
from tunetrail.llm.tokens import bucket_of, byte_classes, hashes, mixed, packed, packed_keys, slices, tokenize, unpacked, unpacked_keys

ORDER = 2
#: Counts up to K are discounted by Good-Turing's estimate; larger ones by TRUSTED of a count.
K, TRUSTED = 5, 0.1
#: Tokens of a partition of the tables of counts, about.
BUCKET_TOKENS = 2_000_000
#: Documents of a block at most; a document's number within it takes so many bits.
DOC_BITS = 20

_CLASSES = byte_classes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Hash of the end of a text (no word holds a line feed), and of the contexts before its first word.
_END, _START = hashes(pa.array([b"\n", b"\r"], pa.binary()))

_BLOCK = "block long, docs binary, train binary, lengths binary, words binary, ids binary, tokens long"


def _code(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    """Blocks of coded documents: ids, training flags, numbers of tokens, the hashes of the words, and every token."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in it:
            for part in slices(batch, 2):
                t = tokenize(part.column(2), _CLASSES)
                lengths = np.bincount(t.text, minlength=part.num_rows) + 1
                ids = np.full(len(t.ids) + part.num_rows, len(t.words), dtype=np.uint32)  # ends, where no word is put
                ids[np.arange(len(t.ids)) + t.text] = t.ids
                words = np.append(hashes(t.words), _END)
                columns = [[number], [part.column(0).to_pylist()], [np.packbits(part.column(1).to_numpy(zero_copy_only=False)).tobytes()], [packed(lengths)], [words.tobytes()], [packed(ids)], [int(lengths.sum())]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _schema(part.schema.field(0).type))], schema=_schema(part.schema.field(0).type))
                number += 1

    return src.mapInArrow(run, _BLOCK.replace("docs binary", f"docs array<{id_type}>"))


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("docs", pa.list_(id_type)), ("train", pa.binary()), ("lengths", pa.binary()), ("words", pa.binary()), ("ids", pa.binary()), ("tokens", pa.int64())])


class Block:
    """A block's tokens, decoded, with their n-grams up to an order."""

    def __init__(self, row: dict, order: int) -> None:
        self.lengths = unpacked(row["lengths"])
        n = len(self.lengths)
        self.train = np.unpackbits(np.frombuffer(row["train"], np.uint8), count=n).astype(bool)
        words, ids = np.frombuffer(row["words"], np.uint64), unpacked(row["ids"])
        self.doc = np.repeat(np.arange(n), self.lengths)
        self.first = np.append(0, np.cumsum(self.lengths)[:-1])  # each document's first token
        word = words[ids]
        #: For each order: hash of the n-gram that ends at a token, and of its context, the n - 1 tokens before.
        self.grams, self.contexts = [word], [np.full(len(word), _START)]
        for _ in range(1, order):
            context = np.roll(self.grams[-1], 1)
            context[self.first] = _START
            self.contexts.append(context)
            self.grams.append(mixed(context, word))

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct n-grams (index n) in rising order, the place of each token's among them, and their counts in training documents."""
        keys, inverse = np.unique(self.grams[n], return_inverse=True)
        return keys, inverse, np.bincount(inverse, weights=self.train[self.doc], minlength=len(keys)).astype(np.int64)


def _counts(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """The tables of counts: (n, bucket, block, totals, owned, hist), a row for what each block asked of each partition."""

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in batch.to_pylist():
                block = Block(row, order)
                for n in range(order):
                    keys, _, counts = block.distinct(n)
                    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
                    rows = [(n, b, row["block"], packed_keys(keys[i:j]), packed(counts[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
                    yield pa.RecordBatch.from_pylist([dict(zip(("n", "bucket", "block", "keys", "counts"), r)) for r in rows], schema=asked)

    asked = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
    replied = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()), ("owned", pa.binary()), ("hist", pa.list_(pa.int64()))])

    def total(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        keys = [unpacked_keys(k.as_py()) for k in rows.column("keys")]
        counts = np.concatenate([unpacked(c.as_py()) for c in rows.column("counts")])
        _, index, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        totals = np.bincount(inverse, weights=counts).astype(np.int64)
        owned = np.zeros(len(counts), dtype=bool)
        owned[index[totals > 0]] = True
        totals = totals[inverse]
        out, at = [], 0
        for n, bucket, block, k in zip(rows.column("n").to_pylist(), rows.column("bucket").to_pylist(), rows.column("block").to_pylist(), keys):
            here = slice(at, at + len(k))
            mine = totals[here][owned[here]]
            hist = [*np.bincount(np.minimum(mine, K + 2), minlength=K + 3)[1:K + 2].tolist(), len(mine), int(mine.sum())]
            out.append({"n": n, "bucket": bucket, "block": block, "totals": packed(totals[here]), "owned": np.packbits(owned[here]).tobytes(), "hist": hist})
            at += len(k)
        return pa.Table.from_pylist(out, schema=replied)

    requests = blocks.mapInArrow(ask, "n int, bucket int, block long, keys binary, counts binary")
    return requests.groupBy("n", "bucket").applyInArrow(total, "n int, bucket int, block long, totals binary, owned binary, hist array<long>")


def discounts(of: list[int], k: int = K) -> np.ndarray:
    """d(r) for r = 0 .. k from the counts of counts n(1) .. n(k + 1): Good-Turing's estimate, as Katz has it, with the
    largest cut at most ``k`` for which all are between 0 and 1; if there is none, absolute discounts by n(1) / (n(1) + 2 n(2))."""
    n = [0, *of]
    out = np.ones(k + 1)
    for cut in range(k, 1, -1):
        if all(n[1:cut + 2]):
            rest = (cut + 1) * n[cut + 1] / n[1]
            d = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if rest < 1 else 0.0 for r in range(1, cut + 1)]
            if all(0 < x < 1 for x in d):
                out[1:cut + 1] = d
                out[cut + 1:] = [(r - TRUSTED) / r for r in range(cut + 1, k + 1)]
                return out
    share = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    out[1:] = [(r - share) / r for r in range(1, k + 1)]
    return out


def kept_counts(totals: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts d(r) r."""
    k = len(d) - 1
    return np.where(totals <= k, d[np.minimum(totals, k)] * totals, totals - TRUSTED)


def _evaluate(blocks: DataFrame, counts: DataFrame, order: int, buckets: int, id_type: str, stats: list[list[int]], train_docs: int) -> DataFrame:
    """Rows of three kinds, dealt by ``n`` and ``bucket``: 0, a block's shares of its contexts' sums; 1, the contexts whose
    weights a block needs, with documents and times; 2, documents, with the logarithms of what they hold of seen n-grams."""
    d = [discounts(s[:K + 1]) for s in stats]
    tokens, types = stats[0][K + 2], stats[0][K + 1]
    seen = np.array(stats[0][:K])
    unknown = float(((np.arange(1, K + 1) * (1 - d[0][1:])) * seen).sum() + TRUSTED * (types - seen.sum())) / tokens if tokens else 1.0

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = _out_schema(left.schema.field("docs").type.value_type)
        rows: list[dict] = []
        replies = sorted(right.to_pylist(), key=lambda r: (r["n"], r["bucket"]))
        for row in left.to_pylist():
            block, base = Block(row, order), row["block"] << DOC_BITS
            low = score = flat = known = before = None
            for n in range(order):
                mine = [r for r in replies if r["n"] == n]
                found = [unpacked(r["totals"]) for r in mine]
                own = np.concatenate([np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=len(f)).astype(bool) for r, f in zip(mine, found)])
                keys, first, inverse = np.unique(block.grams[n], return_index=True, return_inverse=True)
                totals = np.concatenate(found)[inverse]
                if n == 0:
                    known = totals > 0
                    low = np.where(known, kept_counts(totals, d[0]) / max(1, tokens), unknown)  # of a seen n-gram, by the orders so far
                    score, flat = np.log10(low), np.log10((totals + 1) / (tokens + types + 1))
                else:
                    context = np.roll(before, 1)
                    context[block.first] = train_docs
                    own = first[own]  # a token of each n-gram that this block owns
                    left_over = (totals[own] - kept_counts(totals[own], d[n])) / np.maximum(1, context[own])
                    rows += _dealt(0, n, buckets, block.contexts[n][own], {"mass": left_over, "low": low[own]})
                    here = totals > 0
                    low = np.where(here, kept_counts(totals, d[n]) / np.maximum(1, context), low)
                    score = np.where(here, np.log10(low), score)
                    missed = ~here & (context > 0)
                    rows += _dealt(1, n, buckets, block.contexts[n][missed], {}, block.doc[missed], base)
                before = totals
            per_doc = [np.bincount(block.doc, weights=x, minlength=len(block.lengths)) for x in (known, flat, score)]
            for i, (doc, length, *x) in enumerate(zip(row["docs"], block.lengths.tolist(), *(p.tolist() for p in per_doc))):
                rows.append({"bucket": row["block"] % buckets, "kind": 2, "n": 0, "rid": base + i, "doc": doc, "n_tokens": length, "n_known": int(x[0]), "base": x[1], "score": x[2]})
        return pa.Table.from_pylist(rows, schema=schema)

    return blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(walk, _OUT.format(id_type))


_OUT = "bucket int, kind int, n int, keys binary, mass binary, low binary, at binary, docs binary, times binary, base_rid long, rid long, doc {}, n_tokens long, n_known long, base double, score double"


def _out_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "double": pa.float64(), "{}": id_type}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in _OUT.split(", "))])


def _dealt(kind: int, n: int, buckets: int, contexts: np.ndarray, sums: dict[str, np.ndarray], docs: np.ndarray | None = None, base: int = 0) -> list[dict]:
    """Rows for the buckets of the contexts: with the sums by context, or with the documents that need them."""
    keys, place = np.unique(contexts, return_inverse=True)
    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    totals = {name: np.bincount(place, weights=x, minlength=len(keys)) for name, x in sums.items()}
    if docs is not None:
        pairs, times = np.unique(place << DOC_BITS | docs, return_counts=True)
        ends = np.searchsorted(pairs >> DOC_BITS, np.arange(len(keys) + 1))
    out = []
    for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if j > i:
            row = {"bucket": b, "kind": kind, "n": n, "keys": packed_keys(keys[i:j]), **{name: x[i:j].tobytes() for name, x in totals.items()}}
            if docs is not None:
                part = slice(ends[i], ends[j])
                row |= {"at": packed(np.diff(ends[i:j + 1])), "docs": packed(pairs[part] & (1 << DOC_BITS) - 1), "times": packed(times[part]), "base_rid": base}
            out.append(row)
    return out


def _backed(rows: DataFrame, id_type: str) -> DataFrame:
    """(rid, backed, doc, ...): documents, and what the weights of the contexts that they lack add to them.

    In each partition of contexts the sums come first and become weights, then the blocks that need some pass by."""
    columns = ["rid", "backed", "doc", "n_tokens", "n_known", "base", "score"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sums, keys, weights = None, [], None, None
        for batch in it:
            schema = pa.schema([("rid", pa.int64()), ("backed", pa.float64()), *[batch.schema.field(c) for c in columns[2:]]])
            kinds = batch.column("kind").to_numpy()
            docs = batch.filter(pa.array(kinds == 2)).select([c for c in columns if c != "backed"])
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays([docs.column(0), pa.nulls(docs.num_rows, pa.float64()), *docs.columns[1:]], schema=schema)
            for row in batch.filter(pa.array(kinds < 2)).select(["n", "bucket", "kind", "keys", "mass", "low", "at", "docs", "times", "base_rid"]).to_pylist():
                if (row["n"], row["bucket"]) != group:
                    group, sums, keys = (row["n"], row["bucket"]), [], None
                if row["kind"] == 0:
                    sums.append((unpacked_keys(row["keys"]), np.frombuffer(row["mass"]), np.frombuffer(row["low"])))
                    continue
                if keys is None:
                    every, mass, low = (np.concatenate(x) for x in zip(*sums))
                    keys, place = np.unique(every, return_inverse=True)
                    mass, low = (np.bincount(place, weights=x) for x in (mass, low))
                    weights, sums = np.log10(mass / np.maximum(1 - low, 1e-12)), []
                each = weights[np.searchsorted(keys, unpacked_keys(row["keys"]))]
                rids, place = np.unique(unpacked(row["docs"]), return_inverse=True)
                added = np.bincount(place, weights=np.repeat(each, unpacked(row["at"])) * unpacked(row["times"]))
                yield pa.RecordBatch.from_arrays([pa.array(rids + row["base_rid"]), pa.array(added), *[pa.nulls(len(rids), f.type) for f in list(schema)[2:]]], schema=schema)

    ordered = rows.repartition("n", "bucket").sortWithinPartitions("n", "bucket", "kind")
    return ordered.mapInArrow(run, f"rid long, backed double, doc {id_type}, n_tokens long, n_known long, base double, score double")


def score_texts(docs: DataFrame, train: Column, order: int = ORDER, bucket_tokens: int = BUCKET_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (the model), both
    sums of base-10 logarithms of probabilities.

    The model learns from the rows where ``train`` is true (null counts as false).  Tokens are the words between ASCII
    white space, A-Z in lower case, and one end; a null, empty or blank text is its end alone.  Null and repeated ids
    give a row each, and each row is learnt from.  Without training rows every token is unknown, which is then certain:
    scores are 0.  No rows give no rows.  Other columns don't matter, whatever their names.
    """
    blocks = stored(_code(docs, id_col, text_col, train))
    id_type = docs.schema[id_col].dataType.simpleString()
    n_tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, -(-n_tokens // bucket_tokens))
    counts = checkpointed(_counts(blocks, order, buckets))
    stats = [[0] * (K + 3) for _ in range(order)]
    for r in counts.groupBy("n").agg(*[F.sum(F.col("hist")[i]) for i in range(K + 3)]).collect():  # a row for each order
        stats[r["n"]] = list(r)[1:]
    train_docs = docs.where(F.coalesce(train, F.lit(False))).count()
    rows = _backed(_evaluate(blocks, counts, order, buckets, id_type, stats, train_docs), id_type)
    whole = rows.groupBy("rid").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("doc", "n_tokens", "n_known", "base", "score")], F.coalesce(F.sum("backed"), F.lit(0.0)).alias("backed"))
    return whole.select(F.col("doc").alias(id_col), "n_tokens", "n_known", F.lit(stats[0][K + 2]).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
                        (F.col("score") + F.col("backed")).alias("score"))
