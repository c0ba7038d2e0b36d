"""Line dedup against a plain count of the same rows."""

from collections import defaultdict

from riskweave.llm.line_dedup import boilerplate, drop_boilerplate
from tests.llm.data import CLASHING, awkward_docs, empty_docs


def brute(rows, ratio, min_pages):
    pages, held = defaultdict(set), defaultdict(set)
    for page, r in enumerate(rows):
        if r.text is not None:
            pages[r.source].add(page)
            for line in r.text.split("\n"):
                if line.strip(" "):
                    held[r.source, line.strip(" ")].add(page)
    drop = {k for k, v in held.items() if len(v) >= min_pages and len(v) > ratio * len(pages[k[0]])}
    return [
        (r.doc_id, None if r.text is None else "\n".join(x for x in r.text.split("\n") if not x.strip(" ") or (r.source, x.strip(" ")) not in drop))
        for r in rows
    ], drop


def test_matches_plain_count(spark):
    rows = []
    for i in range(60):
        host = ["a", "b", None][i % 3]
        lines = [f"own {i}", "", "  footer of " + str(host) + " "] + (["menu"] if i % 4 == 0 else []) + (["rare"] if i < 3 else [])
        rows.append((i, "\n".join(lines), "en", host, 0))
    rows += [(100 + i, "footer copy\nown page", "en", "c", 0) for i in range(50)]  # copies of one page
    rows += [(200, None, "en", "a", None), (201, "", "en", "a", 0), (5, rows[5][1], "en", rows[5][3], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want, dropped = brute(docs.collect(), 0.05, 5)
    out = drop_boilerplate(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(want, key=str)
    # copies are pages: the template of a copied page goes, its own line with it, rare lines stay
    assert {("c", "footer copy"), ("c", "own page")} <= dropped and not any(line == "rare" for _, line in dropped)
    assert all(r.text is None or r.n_chars in (len(r.text), 0) for r in out)
    assert boilerplate(docs).count() == len(dropped)


def test_awkward_rows(spark):
    docs = awkward_docs(spark, clashing=True)
    out = drop_boilerplate(docs, min_pages=2, ratio=0.2, counts=True)
    assert out.columns == [c.split()[0] for c in CLASHING.split(", ")] + ["n_lines", "n_dropped"]
    want, _ = brute(docs.collect(), 0.2, 2)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)
    assert drop_boilerplate(empty_docs(spark)).count() == 0


def test_lines_by_different_texts_are_counted_beside(spark):
    """A copied page's own line is boilerplate by pages, not by texts; a footer is by both."""
    rows = [(i, "copied page\nfooter", "a") for i in range(20)]
    rows += [(100 + i, f"own {i}\nfooter", "a") for i in range(20)] + [(200, None, "a"), (201, "own 1\nfooter", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in drop_boilerplate(docs, counts=True, by_text=True).collect()}
    assert (out[0].text, out[0].n_dropped, out[0].n_dropped_by_text) == ("", 2, 1)
    assert (out[100].text, out[100].n_dropped, out[100].n_dropped_by_text) == ("own 0", 1, 1)
    assert (out[200].text, out[200].n_dropped_by_text) == (None, 0) and out[201].n_dropped_by_text == 0
