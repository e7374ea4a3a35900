import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import edge_docs, edge_rows, empty_docs
from tunetrail.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_tokenizers():
    exact, encode = Tokenizer.from_file(PATH), packing.encoder(packing.vocabulary(PATH))
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} {chr(c)}  x" for c in range(0, 0x110000, 61) if not 0xD800 <= c < 0xE000]
    texts += ["", "x<|endoftext|>y <|endoftext|>", " " * 5000, "\n\n \n  a", "a" * 20000, "1" * 3000 + "!" * 3000, "don't we'll I'VE 'S", *[t or "" for _, t, *_ in edge_rows()]]
    assert [encode(t) for t in texts] == [e.ids for e in exact.encode_batch_fast(texts, add_special_tokens=False)]


def test_ids_of_every_code_point():
    exact, encode = Tokenizer.from_file(PATH), packing.encoder(packing.vocabulary(PATH))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 64):
        text = "".join(f"a{c}b {c}{c}1{c} {c}  x\n" for c in points[k:k + 64])
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_ids_of_very_long_white_space(spark):
    exact, encode = Tokenizer.from_file(PATH), packing.encoder(packing.vocabulary(PATH))
    texts = ["x" + " " * 1_000_000 + "a", "x" + "\n" * 3_000_000 + "a", "<|endoftext|>" + " \n\t" * 700_000, " " * packing.SAFE_RUN + "a", "é" + "\u3000" * (packing.SAFE_RUN + 1) + "b"]
    for text in texts:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, texts[0]), (2, "two words")], "doc_id long, text string")
    lengths = {r.doc_id: r.n for r in packing.pack_documents(docs, packing.vocabulary(PATH)).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert lengths == {1: 1_000_002, 2: 3}


def test_what_tiktoken_refuses_goes_to_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "SAFE_RUN", 1 << 40)  # the run is not seen beforehand
    text = "x" + " " * 1_000_000 + "a"
    assert packing.encoder(packing.vocabulary(PATH))(text) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def naive(lengths, capacity):
    """Best-fit decreasing, one piece after the other."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if capacity - sum(b) >= n]
        if fit:
            min(fit, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return sorted(map(sum, bins))  # which of equally tight sequences is taken changes what they hold, not how full they get


def test_plan_is_best_fit_decreasing():
    r = random.Random(7)
    for capacity in (1, 7, 16, 64, 100):
        for _ in range(25):
            lengths = [r.randint(1, r.choice([capacity, max(1, capacity // 3)])) for _ in range(r.randint(0, 150))]
            counts = {n: lengths.count(n) for n in set(lengths)}
            plan, bins = packing.plan_best_fit(counts, capacity), {}
            for k, (n, first, sequence, per, offset) in enumerate(plan):
                end = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == n else counts[n]
                for rank in range(first, end):
                    bins.setdefault(sequence + (rank - first) // per, []).append((offset + (rank - first) % per * n, n))
            for places in bins.values():
                at = 0
                for offset, n in sorted(places):
                    assert offset == at
                    at += n
                assert at <= capacity
            assert sorted(sum(n for _, n in places) for places in bins.values()) == naive(lengths, capacity)


def test_room_tree_finds_the_tightest():
    r = random.Random(3)
    for n in (1, 2, 5, 33, 2048):
        tree, some = packing.RoomTree(n), set()
        for _ in range(300):
            room = r.randint(1, n)
            tree.put(room, room not in some)
            some ^= {room}
            want = r.randint(1, n)
            assert tree.tightest(want) == min((x for x in some if x >= want), default=None)


def test_pieces_and_places(spark):
    exact = Tokenizer.from_file(PATH)
    pieces = packing.token_pieces(edge_docs(spark), packing.vocabulary(PATH), with_ids=True).collect()
    want = sorted((str(i), exact.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, *_ in edge_rows())
    docs, parts = [], sorted(pieces, key=lambda p: (str(p.doc_id), p.piece))
    whole = {}
    for p in parts:
        assert p.length == len(p.ids) <= 2048 and (p.piece == 0 or p.length == 2048)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for i, ids in want:  # repeated ids make equal or several documents, so each document is looked up by its pieces
        first = (len(ids) - 1) % 2048 + 1
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            whole.setdefault((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())), []).append(1)
    assert sorted(k for k, v in whole.items() for _ in v) == sorted((str(p.doc_id), p.piece, p.start, p.length, p.ids_crc32) for p in parts)
    packed = packing.pack_documents(edge_docs(spark), packing.vocabulary(PATH)).collect()
    assert len(packed) == len(parts)
    sequences = {}
    for p in packed:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    assert sorted(sum(n for _, n in v) for v in sequences.values()) == naive([p.length for p in packed], 2048)
    assert packing.pack_documents(empty_docs(spark), packing.vocabulary(PATH)).collect() == []


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("select 1L doc_id, cast(x'61ff62' as string) text union all select 2L, 'a�b'")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(docs, packing.vocabulary(PATH)).collect()}
    assert got[1] == got[2]
