"""Shares and divergences against plain integers; terms whose digests collide."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import divergence as D
from riskweave.llm.queries import op13_source_divergence
from tests.llm.data import awkward_docs, empty_docs, on_disk


def plain(docs, top=200, scale=10**9):
    n, seen = defaultdict(Counter), defaultdict(Counter)
    for r in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        n[r.lang or "", r.source or ""].update(terms)
        seen[r.lang or ""].update(set(terms))
    out = []
    for lang, docs_of in seen.items():
        kept = [t for t, k in docs_of.items() if k >= 3]
        groups = [s for x, s in n if x == lang]

        def shares(count, kept=kept):
            over = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + scale * (count[t] + 1) // over for t in kept}

        p = {s: shares(n[lang, s]) for s in groups}
        q = shares(sum((n[lang, s] for s in groups), Counter()))
        for s in groups:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            marked = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, len(pairs)), ("term", marked, top)):
                rows.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k) for k, x in enumerate(rows[:most], 1)]
    return sorted(out)


def docs_of(spark, docs, seed=1, sources=7):
    r = random.Random(seed)
    words = ["the", "The", "über", "Über", "中文", "x1y", "don't", "a", "é"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for k in range(150):
        lang = r.choice(["en", "en", "de", None])
        text = " ".join(r.choice(words[: r.randint(5, len(words))]) for _ in range(r.randint(0, 40)))
        rows.append((k, text, lang, f"s{int(r.random() ** 3 * sources)}", 1))
    rows += [(500, "only once seen", "fr", "s1", 1), (501, "", "fr", "s2", 1), (502, "again", "it", "s1", 1)]
    return docs.union(spark.createDataFrame([(*x, *[None] * (len(docs.columns) - 5)) for x in rows], docs.schema))


@pytest.mark.parametrize(("block_rows", "pair_rows", "top"), [(200_000, 64, 200), (25, 2, 3)])
def test_against_plain_integers(spark, block_rows, pair_rows, top):
    docs = docs_of(spark, awkward_docs(spark, clashing=True))
    got = D.audit(docs, block_rows=block_rows, pair_rows=pair_rows, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(docs.collect(), top)


def test_terms_of_one_digest_are_parted(spark, monkeypatch):
    docs = docs_of(spark, awkward_docs(spark))
    monkeypatch.setattr(D, "digest_of", lambda term: len(term) % 5)
    counted = D.term_counts(docs)
    rows, terms = D.keyed(counted)
    assert terms.count() == terms.select("term").distinct().count() == counted.select("term").distinct().count()
    assert sorted(map(tuple, D.audit(docs).collect())) == plain(docs.collect())


def test_counts_in_small_steps(spark, monkeypatch):
    text = "One two.Three é 12 über " * 50
    assert [t for s in D.term_steps(text.encode(), 7) for t in s] == [t.encode() for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.replace("O", "o").replace("T", "t"))]
    monkeypatch.setattr(D, "HELD_TERMS", 3)
    docs = docs_of(spark, awkward_docs(spark), seed=2)
    assert sorted(map(tuple, D.audit(docs).collect())) == plain(docs.collect())


def test_blocks_count_like_plain_counters():
    r = random.Random(3)
    words = ["The", "über", "中文", "x1y", "a", "é", "", "don't", "  "]
    texts = ["", "end", "start", " ", "Ü", *("".join(r.choice(words) + r.choice(" .-") for _ in range(r.randint(0, 30))) for _ in range(200)), "last"]
    group = np.array([r.randint(5, 9) for _ in texts])
    data = [t.encode() for t in texts]
    terms, text = D.block_terms(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert list(zip(text.tolist(), terms.to_pylist(), strict=True)) == [(k, t) for k, d in enumerate(data) for s in D.term_steps(d) for t in s]
    want_n, want_docs = Counter(), Counter()
    for k, d in enumerate(data):
        found = [(int(group[k]), t) for s in D.term_steps(d) for t in s]
        want_n.update(found)
        want_docs.update(set(found))

    def told(counts):
        rows = list(zip(counts[0].tolist(), counts[1].to_pylist(), *(x.tolist() for x in counts[2:]), strict=True))
        assert len(rows) == len({x[:2] for x in rows})
        return {x[:2]: x[2:] for x in rows}

    assert told(D.block_counts(terms, text, group)) == {x: (n, want_docs[x]) for x, n in want_n.items()}
    halves = [D.block_counts(terms.filter(pa.array(at)), text[at], group) for at in (text < 90, text >= 90)]
    nothing = D.block_counts(terms[:0], text[:0], group)
    assert told(nothing) == told(D.merged([nothing, nothing])) == {}
    assert told(D.merged([*halves, nothing])) == {x: (n, want_docs[x]) for x, n in want_n.items()}


def test_a_task_digests_a_term_once(spark, tmp_path, monkeypatch):
    # before, a task did all its work on a term anew for every source and language
    def digest(term, path=str(tmp_path / "digested"), real=D.digest_of):
        with open(path, "ab") as f:
            f.write(term + b"\n")
        return real(term)

    monkeypatch.setattr(D, "digest_of", digest)
    counted = D.term_counts(docs_of(spark, awkward_docs(spark)).coalesce(1))
    digested = (tmp_path / "digested").read_bytes().split()
    assert len(digested) == len(set(digested)) == counted.where("new").count() == counted.select("term").distinct().count()


@pytest.mark.parametrize("held", [3, 1_000_000])
def test_long_texts_are_one_document(spark, monkeypatch, held):
    monkeypatch.setattr(D, "HELD_TERMS", held)
    monkeypatch.setattr(D, "STEP_BYTES", 40)
    monkeypatch.setattr(D.term_steps, "__defaults__", (40,))
    docs = docs_of(spark, awkward_docs(spark), seed=4)
    assert sorted(map(tuple, D.audit(docs).collect())) == plain(docs.collect())


def test_large_counts_stay_exact(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13, 7), (0, 0, 1), (2 * 10**12, 2 * 10**12, 2)], "n long, total long, v long")
    got = [r.p for r in rows.select(D._share("n", "total").alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 1) // (t + v) for n, t, v in ((10**13, 3 * 10**13, 7), (0, 0, 1), (2 * 10**12, 2 * 10**12, 2))]


def test_query_on_disk(spark, tmp_path):
    docs = on_disk(docs_of(spark, awkward_docs(spark)), tmp_path)
    assert sorted(map(tuple, op13_source_divergence(spark, str(tmp_path)).collect())) == plain(docs.collect())


def test_empty_tables(spark):
    assert D.audit(empty_docs(spark)).count() == 0
