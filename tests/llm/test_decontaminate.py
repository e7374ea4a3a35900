import hashlib
import re

from tests.llm.helpers import edge_docs, edge_rows, empty_docs, prose
from tunetrail.llm import decontaminate as D

ITEMS = [(1, " ".join(prose(1, 120).split()[30:60])), (2, prose(3, 50)[:400]), (2, "a B c"), (3, "A"), (4, "word"), (5, None), (6, ""), (None, "two words"), (10, " ".join(prose(1, 120).split()[30:60])), (11, " ".join(["a"] * 40))]


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))


def brute(rows, items, window=13):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (s := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= s
        out.append((str(doc), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_equals_brute_force(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute([(i, t) for i, t, *_ in edge_rows()], ITEMS)
    for size in (D.BLOCK_BYTES, 150):  # searched in the tasks, and joined with the patterns
        found = D.find_contamination(edge_docs(spark), bench, block_bytes=size, keep=("node", "n_chars"))
        got = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
        assert found.where("node = 'n'").count() == len(want)


def test_spans_and_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c y word", 5)], "doc_id long, text string, n_words int")
    row = D.find_contamination(docs, bench).first()
    assert row.hit_spans == [1, 4, 5, 6] and row.item_ids == ["2", "3", "4"]
    assert D.find_contamination(empty_docs(spark), bench).collect() == []
    none = D.find_contamination(docs, bench.limit(0)).first()
    assert (none.n_words, none.n_hit, none.n_items, none.contaminated) == (6, 0, 0, False)


def test_search_skips():
    s = D.searchers([("1", " ".join(f"w{i}" for i in range(20)).encode())])[0]
    assert (s.least, s.block, s.default) == (13, 3, 11)
    text = [b"z"] * 1000 + [f"w{i}".encode() for i in range(3, 17)]
    assert [(a, b) for a, b, _ in s.occurrences(text)] == [(1000, 1013), (1001, 1014)]


def test_joined_patterns_of_a_large_benchmark(spark):
    """Patterns on Spark: many items share a window, copies of a text are a third of all rows, few shift slots let false positions through."""
    rows = [(i, prose(1, 120)) for i in range(40)] + [(100 + i, prose(i, 90) + " a b c " * (i % 3)) for i in range(80)] + [(None, "a"), (500, None), (501, "")]
    items = [(1000 + i, prose(1, 120)) for i in range(60)] + [(i, " ".join(prose(i, 90).split()[i % 40:][:30])) for i in range(0, 80, 7)] + [(7, "A b"), (8, "c")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(docs, bench, block_bytes=1000, slots=1 << 9).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, items)


def test_hashed_shifts_skip_no_pattern(spark):
    text = " ".join(f"w{i}" for i in range(20)).encode()
    tables = D.hashed_shifts(D.benchmark_patterns(spark.createDataFrame([("1", bytearray(text)), ("2", bytearray(b"a b"))], "item string, text binary")))
    assert sorted(tables) == [2, 13] and all(len(t) == D.SLOTS for t in tables.values())
    assert sorted(set(tables[13].tolist())) == list(range(12)) and sorted(set(tables[2].tolist())) == [0, 1]


def test_search_and_count_are_one_python_pass(spark):
    """Each Python step of a stage has a worker of its own beside each task, which stays for the steps that follow."""
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    small = D.find_contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert small._jdf.queryExecution().executedPlan().toString().count("MapInArrow ") == 1
