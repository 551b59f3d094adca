"""Ranked search, spelling groups and suffix-tree scores against brute force, on odd rows and whole small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eventlift.llm import lexical, suffix_tree, variants
from eventlift.llm.ship import ship

SF = "/root/testdata/sf0.001"
#: Columns named like those that the operators make.
DOCS = "doc_id long, text string, lang string, score double, rank int, n long, item long, key long, train boolean, chunk long"
ODD = [(1, "A b, c\tÉa x9 É"), (2, "a b c"), (2, "a b c"), (3, None), (4, ""), (None, "a b b"), (5, "\x00a\x7fb..."), (6, "long word " * 20_000), (7, "a" * 40_000), (8, "  \n")]


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def docs(session, rows):
    return session.createDataFrame([(i, t, "en", 1.0, 2, 3, 4, 5, True, 6) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def given(session):
    return [(r.doc_id + 10, r.text) for r in session.read.parquet(f"{SF}/documents.parquet").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_ranks(rows, items, top):
    counts = [(d, Counter(terms(t))) for d, t in rows]
    having = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * having) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * having + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def test_ranks_equal_brute_force(session, given):
    rows = ODD + given
    items = [(1, "a B c"), (1, "É x9 zzz"), (2, None), (3, ""), (None, "word"), *((i, t) for i, t in given[:30])]
    frame = session.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, item long")
    for top in (3, 50):
        assert sorted((tuple(r) for r in lexical.ranked(docs(session, rows), frame, top).collect()), key=str) == brute_ranks(rows, items, top)
    assert lexical.ranked(docs(session, rows).limit(0), frame).count() == 0
    assert lexical.ranked(docs(session, rows), frame.limit(0)).count() == 0


def test_items_in_blocks_give_the_same(session, given, monkeypatch):
    items = session.createDataFrame(given[:20], "item_id long, text string")
    whole = sorted(tuple(r) for r in lexical.ranked(docs(session, given), items, 5).collect())
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    assert sorted(tuple(r) for r in lexical.ranked(docs(session, given), items, 5).collect()) == whole


def test_limited_accumulators_keep_the_best():
    rng = np.random.default_rng(5)
    passed = 0
    for _ in range(200):
        n, lists = 300, []
        for share in sorted(rng.uniform(0.005, 0.9, 6)):
            doc = np.flatnonzero(rng.random(n) < share)
            lists.append((doc, rng.integers(0, int(30 / share), len(doc))))
        exact = np.zeros(n, np.int64)
        for doc, score in lists:
            exact[doc] += score
        for least in (0, int(np.sort(exact)[-5])):
            found, over = lexical.evaluate(lists, n, 5, least)
            kth = max(least, np.sort(exact)[-5], 1)
            assert (found[exact >= kth] == exact[exact >= kth]).all() and (found <= exact).all()
            passed += over
    assert passed > 1000


def brute_groups(rows):
    words = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    cuts = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cuts[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for (i, cut), group in cuts.items():
        for w in group:
            near[w] |= group - {w}
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def test_spelling_groups_equal_brute_force(session, given):
    planted = [(900, "banana " * 40 + "banan " * 9 + "banane bananes bananesx " * 3), (901, "ÀÉîøü Àéîøü " * 5 + "Àéîøüs " * 20), (902, "x" * 3000 + " " + "x" * 2999 + " " + "x" * 3000), (903, ("x" * 3000 + " ") * 3 + ("x" * 2999 + " ") * 9)]
    rows = ODD + planted + given
    assert sorted((tuple(r) for r in variants.spelling_groups(docs(session, rows)).collect()), key=str) == brute_groups(rows)
    assert variants.spelling_groups(docs(session, rows).limit(0)).count() == 0


def test_near_words_in_small_tiles(session):
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abé"), rng.integers(5, 9))) for _ in range(700)})
    frame = session.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        return a != b and (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1 or len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b))))

    want = sorted((a, b, words.index(b)) for a in words for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b))
    for tile in (4, 10_000):
        assert sorted(tuple(r) for r in variants.near_words(frame, tile).collect()) == want  # each once


def test_roots_of_long_chains(session):
    chain = session.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("a", "w20")], "word string, form string")
    assert {r.root for r in variants.roots(chain).collect()} == {"w21"}


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def test_normalised_bytes():
    texts = ["A  b\tÇ\n", None, "", " x", "y y", "\x00 z"]
    data, at = suffix_tree.normalised(pa.array(texts, pa.string()))
    assert [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:])] == [b"\t" * 5 + " ".join(tokens(t)).encode() + b"\n" for t in texts]


def brute_tree(texts):
    """Counts of contexts with their next bytes, of retained contexts only."""
    counts = defaultdict(Counter)
    for text in texts:
        data = b"\t" * 5 + " ".join(tokens(text)).encode() + b"\n"
        for i in range(5, len(data)):
            for k in range(6):
                counts[data[i - k : i]][data[i]] += 1
    kept = {b""}
    for s, own in counts.items():
        c = sum(own.values())
        up = counts[s[1:]]
        gain = sum(n * math.log(n / up[a]) for a, n in own.items()) - c * math.log(c / sum(up.values()))
        if s and c >= suffix_tree.LEAST and gain > len(own) * math.log(c) / 2:
            kept |= {s[i:] for i in range(len(s))}
    return {s: counts[s] for s in kept if s in counts}


def brute_score(tree, text):
    data, total = b"\t" * 5 + " ".join(tokens(text)).encode() + b"\n", 0.0
    for i in range(5, len(data)):
        p = 1 / 226
        for k in range(6):
            own = tree.get(data[i - k : i])
            if own is None:
                break
            p = (own[data[i]] + len(own) * p) / (sum(own.values()) + len(own))
        total += math.log10(p)
    return total


def brute_scores(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    learned = [t for (_, t), h in zip(rows, held) if not h]
    c = Counter(w for t in learned for w in [*tokens(t), None])
    n, v, tree = sum(c.values()), len(c), brute_tree(learned)
    out = []
    for (d, t), h in zip(rows, held):
        own = [*tokens(t), None]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((d, h, len(own), sum(c[w] > 0 for w in own), n, base, brute_score(tree, t)))
    return out


def assert_scores(got, want):
    got, want = (sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])) for x in (got, want))
    assert [tuple(r)[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_scores_equal_brute_force(session, given):
    rows = ODD + given
    assert_scores(suffix_tree.scores(docs(session, rows)).collect(), brute_scores(rows))
    assert suffix_tree.scores(docs(session, rows).limit(0)).count() == 0


def test_model_in_shards_gives_the_same(session, given):
    rows = given[:60]
    assert_scores(suffix_tree.scores(docs(session, rows), entries=3000).collect(), brute_scores(rows))


def test_nothing_to_learn_from(session):
    held = [(i, f"some text {i}") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    assert_scores(suffix_tree.scores(docs(session, held)).collect(), brute_scores(held))


def test_next_byte_probabilities_sum_to_one(session, given):
    tree = brute_tree([t for _, t in given[:40]])
    rows = [(len(s) + 1, int.from_bytes(s + bytes([a]), "big"), n) for s, own in tree.items() for a, n in own.items()]
    model = suffix_tree.Model(*(np.array(c) for c in zip(*rows)))
    symbols = np.array([b for b in range(256) if b not in (9, 11, 12, 13) and not 65 <= b < 91])
    for context in (b"the t", b"\t\t\t\t\t", b"zzzzz", b"n the"):
        p = 10 ** model.log10((int.from_bytes(context, "big") << 8) + symbols)
        assert abs(p.sum() - 1) < 1e-9
