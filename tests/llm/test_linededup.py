from collections import defaultdict

from tests.llm.helpers import SCHEMA, edge_docs, edge_rows, empty_docs
from tunetrail.llm import linededup


def strip(line):
    return line.replace("\t", " ").replace("\r", " ").strip(" ")


def brute(rows, min_sites):
    """Texts without the lines on ``min_sites`` sites or more, but at their first place."""
    sites, first = defaultdict(set), {}
    docs = [(i, t or "") for i, t, _ in rows]
    for k, (doc, text, site) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if strip(line):
                sites[strip(line)].add(site)
    for line in sites:
        places = [((doc is not None, doc or 0), text, pos) for doc, text in docs for pos, x in enumerate(text.split("\n")) if strip(x) == line]
        first[line] = {p for p in places if p[0] == min(places)[0]}
    out = []
    for (doc, text, _), (_, body) in zip(rows, docs):
        lines = body.split("\n")
        gone = [pos for pos, x in enumerate(lines) if strip(x) and len(sites[strip(x)]) >= min_sites]
        out.append((doc, text, lines, gone, first))
    return out


def test_equals_brute_force(spark):
    shared = ["Home | About", "Share this page", " Share this page\t", "once"]
    extra = [(200 + i, "\n".join([f"own {i}", shared[i % 3], shared[0] if i % 2 else "", f"pair {i // 2}", "half" if i % 8 < 4 else ""]), None, f"site{i % 8}", 1, *["c"] * 3, 1, 2, 3, "r", "t") for i in range(40)]
    extra.append((None, "half\nnull doc", None, None, 1, *["c"] * 3, 1, 2, 3, "r", "t"))
    docs = edge_docs(spark).union(spark.createDataFrame(extra, SCHEMA))
    rows = [(r[0], r[1], r[3]) for r in [*edge_rows(), *extra]]
    for min_sites in (2, 4, 5, 9):
        got = linededup.remove_boilerplate(docs, min_sites).collect()
        assert len(got) == len(rows) and got[0].__fields__[:13] == docs.columns
        cleaned = defaultdict(list)
        for r in got:
            cleaned[str(r.doc_id)].append((r.text, r.n_lines, r.n_removed))
        left = defaultdict(int)
        for doc, text, lines, gone, _ in brute(rows, min_sites):
            options = cleaned[str(doc)]
            if not gone:
                assert (text, 0 if text is None else len(lines), 0) in options  # unchanged to the byte
                continue
            # every boilerplate line goes, but at its first place
            match = [o for o in options if o[0] is not None and o[1] == len(lines) and len(lines) - len(gone) <= o[1] - o[2]]
            assert any(set(lines[p] for p in range(len(lines)) if p not in gone) <= set(o[0].split("\n")) for o in match)
        wide = {strip(x) for _, _, lines, gone, _ in brute(rows, min_sites) for x in (lines[p] for p in gone)}
        for _, body in {(r.doc_id, r.text) for r in got}:  # a repeated row is one document
            for x in (body or "").split("\n"):
                if strip(x) in wide:
                    left[strip(x)] += 1
        assert dict(left) == dict.fromkeys(wide, 1)  # each once in the corpus, and none lost


def test_exact_near_the_threshold(spark):
    docs = spark.createDataFrame([(i, f"line {i % 3}", f"s{i // 3 % (98 + i % 3 * 4)}") for i in range(1200)], "doc_id long, text string, source string")
    lines = linededup.document_lines(docs)
    want = {f"line {k}": len({f"s{i // 3 % (98 + k * 4)}" for i in range(k, 1200, 3)}) for k in range(3)}
    spread = linededup.line_spread(lines, 100, lg_k=4, band=0.9)  # a coarse sketch: all are near, so all are counted
    assert sorted(r.sites for r in spread.collect()) == sorted(n for n in want.values() if n >= 100)
    assert all(r.exact for r in spread.collect())


def test_empty(spark):
    assert linededup.remove_boilerplate(empty_docs(spark)).collect() == []
