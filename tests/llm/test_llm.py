"""Corpus operators against brute force, exact round trips and held-out accuracy on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlift.llm import decontaminate, langid, passages, queries, simple8b, sketch, template, token_files, warc
from eventlift.llm.graph import components
from eventlift.llm.jaccard import jaccard_components
from eventlift.llm.mixing import mixed
from eventlift.llm.quotes import reply_ordered
from eventlift.llm.ship import ship

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, name string, x long, a long, key long"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="module")
def documents(session):
    return [r.asDict() for r in session.read.parquet(f"{SF}/documents.parquet").collect()]


def docs(session, texts):
    """Documents with columns whose names the operators use inside."""
    return session.createDataFrame([(i, t, "en", "n", 1, 2, 3) for i, t in texts], DOCS)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


ODD = [(1, "a b c d e f g h"), (2, "A  b c d\te f g h"), (3, None), (4, ""), (5, "a b"), (6, "a b"), (6, "a b"), (None, "a b"), (7, "x" * 30_000), (8, "a b c d e f g h i"), (9, "  \n")]


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return sorted((d, len(s), least.get(g)) for (d, _), s, g in zip(rows, sets, group) if d is not None)


def test_jaccard_equals_brute_force(session, documents):
    rng = np.random.default_rng(3)
    near = []
    for n in (4, 7, 12, 30, 60):
        words = [f"w{rng.integers(1000)}" for _ in range(n)]
        for k in range(6):
            changed = list(words)
            for _ in range(k // 2):
                changed[rng.integers(n)] = f"v{rng.integers(1000)}"
            near.append((1000 + len(near), " ".join(changed[: n - k % 2])))
    rows = ODD + near + [(r["doc_id"] + 100, r["text"]) for r in documents]
    got = [tuple(r) for r in jaccard_components(docs(session, rows)).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute_components(rows)
    assert [r for r in got if r[0] is None] == [(None, 1, 5)]
    assert jaccard_components(docs(session, rows).limit(0)).count() == 0


def test_components(session):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (7, 7)]
    got = {r.node: r.root for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 200: 100, 300: 100}


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        values = rng.integers(0, 2**63, n, dtype=np.uint64) * 2 >> rng.integers(0, 64, n).astype(np.uint64)
        values[: n // 3] = 0
        starts, sizes = simple8b.block_starts(np.array([n // 2, 0, n - n // 2]))
        words, offsets = simple8b.encode(values, starts, sizes)
        assert (simple8b.decode(words, offsets, sizes) == values).all()


def test_token_files(session):
    from tokenizers import Tokenizer

    rows = [(5, "b  c\n d"), (2, None), (9, "it's <|endoftext|> x 12 3"), (3, "Éa, b!! " * 3000), (2, ""), (None, "z")]
    got = sorted((tuple(r) for r in token_files.token_index(docs(session, rows), queries.byte_bpe()).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(queries.byte_bpe())
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.token_index(docs(session, rows).limit(0), queries.byte_bpe()).count() == 0


def test_fingerprints(session):
    rows = [(1, "a b c d e f g"), (2, None), (3, "x y z " * 200), (4, "a b c d e f g"), (5, "")]
    got = {r.doc_id: r for r in sketch.fingerprints(docs(session, rows)).collect()}
    order = sorted(rows, reverse=True)
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()
    assert got[1].fingerprint == got[4].fingerprint != got[3].fingerprint
    assert sketch.fingerprints(docs(session, rows[:1])).collect()[0].near_next == 1.0
    assert sketch.fingerprints(docs(session, rows).limit(0)).count() == 0


def test_fingerprints_over_many_ranges_against_sorting(session):
    """Repeated, missing and uneven ids, long texts; the likeness columns follow from the written fingerprints alone."""
    rng = np.random.default_rng(11)
    text = lambda: " ".join(f"w{i}" for i in rng.integers(0, 300, rng.integers(0, 400)))
    rows = [(int(i) ** 3, text()) for i in rng.integers(-40, 40, 120)] + [(None, text()), (None, None), (None, ""), (7, "y " * 60_000)]
    rows += [(7, None), (8, "same"), (8, "same")]
    order = sorted(((t or "", d) for d, t in rows), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    want = []
    for (t, d), (after, _) in zip(order, order[1:] + order[:1]):
        changed = sketch.edited(t, after)
        own, new, following = (sketch._sketches([x])[0] for x in (t, changed, after))
        want.append((d or 0, d is None, len(t), hashlib.sha256(changed.encode()).hexdigest(), str(own), str(new), sketch.likeness(own, new), sketch.likeness(own, following)))
    for frame in (docs(session, rows), docs(session, rows).repartition(5)):
        got = [(r[0] or 0, r[0] is None, *r[1:]) for r in sketch.fingerprints(frame).collect()]
        assert sorted(got) == sorted(want)
    nameless = sketch.fingerprints(docs(session, [(None, "b c"), (None, "a b")])).collect()
    assert sorted(r.edited_sha256 for r in nameless) == sorted(hashlib.sha256(x.encode()).hexdigest() for x in ("a b"[:2] + "b", "b c"[:2] + "a"))
    for row in got:
        a, b = sketch.Sketch.parse(row[4]), sketch.Sketch.parse(row[5])
        assert row[6] == (a.containment(b) or 0.0)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = np.unique(rng.integers(0, 2**63, 40_000, dtype=np.uint64) * 2), np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64) * 2)
    both = np.unique(np.concatenate([a, b]))
    merged = sketch.Sketch.of(a).merged(sketch.Sketch.of(b))
    assert str(merged) == str(sketch.Sketch.of(both)) and str(sketch.Sketch.parse(str(merged))) == str(merged)
    assert sketch.Sketch.of(b).containment(merged) == 1.0
    assert abs(sketch.Sketch.of(a).containment(sketch.Sketch.of(np.unique(np.concatenate([a[::2], b])))) - 0.95) < 0.05


def test_short_texts_contained_in_long_ones():
    rng = np.random.default_rng(5)
    distinct = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * 2)
    estimated = 0
    for n in (3, 8, 20, 50):
        for _ in range(30):
            short, rest = distinct(n), distinct(20_000)
            long = np.unique(np.concatenate([short, rest]))
            assert sketch.Sketch.of(short).containment(sketch.Sketch.of(long)) in (None, 1.0)
            estimated += n == 20 and sketch.Sketch.of(short).containment(sketch.Sketch.of(long)) is not None
            own, other = sketch.Sketch.of(short), sketch.Sketch.of(long)
            assert sketch.likeness(own, other) == sketch.likeness(other, own) == (0.0 if own.containment(other) is None else 1.0)
            half = sketch.Sketch.of(np.unique(np.concatenate([short[::2], rest])))
            assert own.containment(half) is None or abs(own.containment(half) - len(short[::2]) / len(short)) < (0.5 if n > 30 else 1)
        assert sketch.likeness(sketch.Sketch.of(short), sketch.Sketch.of(rest)) == 0.0
    assert estimated >= 28


def test_suffix_automaton_follows_all_substrings_only():
    text = np.array([1, 2, 1, 1, 2, 3, 2, 1, 2], np.uint8)
    to = langid.suffix_automaton(text)
    inside = {tuple(text[i:j].tolist()) for i in range(9) for j in range(i + 1, 10)}
    for a in range(1, 4):
        for b in range(1, 4):
            for c in range(1, 4):
                state = 0
                for x in (a, b, c):
                    state = None if state is None else to[state].get(x)
                assert (state is not None) == ((a, b, c) in inside)


def test_language_held_out(session):
    found = queries.queries()["op4_language_id"](session, "/root/testdata/sf0.01").alias("p").join(session.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.95 and held[1] >= 0 and held[2] <= 1
    odd = docs(session, [(1, None), (2, "12 !"), (3, "das ist")])
    labelled = session.createDataFrame([(1, "en", "the cat"), (2, "de", "das ist ein"), (3, None, "x")], "key long, lang string, text string")
    assert [r.lang_pred for r in langid.predict_language(odd, labelled).orderBy("doc_id").collect()] == ["und", "und", "de"]
    assert langid.predict_language(odd, labelled.limit(0)).select("lang_pred").distinct().collect()[0][0] == "und"


def test_benchmark_hits_equal_brute_force(session, documents):
    items = [(r.item_id, r.text) for r in session.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(6).collect()] + [(900, None), (901, ""), (902, "one two three")]
    long_item = max((t for _, t in items if t), key=len)
    words = long_item.split()
    changed = " ".join([*words[:-1], "otherword"])
    holds = [(6000 + i, f"{r['text'][:200]} {items[i % 6][1]} {r['text'][:200]}") for i, r in enumerate(documents[:12])]
    rows = [(r["doc_id"], r["text"][:600]) for r in documents[:20]] + holds + [(5000, "so " + changed.upper() + " end"), (5001, None), (5002, "a one, two three b")]
    bench = session.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_hits(docs(session, rows), bench).collect()}

    holder = decontaminate.Items([i for i in items if i[1] is not None], 5, decontaminate.rarity_of([t for _, t in items if t is not None], 5), len(items) - 1)
    want = set()
    for d, t in rows:
        w, _ = decontaminate.words_of(pa.array([t], pa.string()))
        for k, n in enumerate(holder.size):
            if n and any(holder.similarity(k, w[i : i + n]) >= 0.75 for i in range(len(w))):
                want.add((d, holder.ids[k]))
    assert (5000, next(i for i, t in items if t == long_item)) in got and (5002, 902) in got
    assert got <= want and len(got) >= 0.95 * len(want)
    assert decontaminate.benchmark_hits(docs(session, rows), bench.limit(0)).count() == 0


def test_near_finds_all_fingerprints_within_the_radius():
    items = decontaminate.Items([(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(30)], 5, {}, 30)
    own = items.windows[16][0]
    rng = np.random.default_rng(5)
    flipped = [int(v) ^ sum(1 << int(b) for b in rng.choice(64, 7, replace=False)) for v in own for _ in range(20)]
    place, window = items.near(np.array(flipped, np.uint64), 16)
    assert {(i, i // 20) for i in range(len(flipped))} <= set(zip(place.tolist(), window.tolist()))


def test_warc_round_trip(session):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(4, "http://a/", "same"), (2, None, "same"), (9, "u\r\nx", trap), (5, "u", None), (6, "u", ""), (None, "u", "same"), (7, "u", "é" * 5000)]
    pages = session.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert set(got) == {4, 2, 9, 5, 6, None, 7}
    for p, _, h in rows:
        data = (h or "").encode()
        assert (got[p].payload_bytes, got[p].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert {p: r.refers_to for p, r in got.items()} == {4: 2, 2: None, 9: None, 5: None, 6: 5, None: 2, 7: None}
    assert [r.record_type for r in warc.archived(pages.where("page_id IN (5, 6)"), 1).collect()] == ["response"] * 2
    assert warc.archived(pages.limit(0)).count() == 0


def test_main_text(session):
    page = '<html><body><div class="menu"><a>x</a></div><main><article><h1>T &amp; U</h1><p>one\n two<p>three<br>four<div class="comments">no</div></article></main><script>var a="<p>";</script><footer>f</footer>'
    rows = [(1, "http://h/1", page), (2, "http://h/2", page.replace("one", "1")), (3, None, None), (4, "nourl", "plain text"), (5, "http://h/3", "<p>off template")]
    got = {r.page_id: r.text for r in template.main_texts(session.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "T & U\none two\nthree four", 2: "T & U\n1 two\nthree four", 3: "", 4: "plain text", 5: "off template"}


def test_main_text_keeps_articles_in_listed_names(session):
    pages = [
        '<html><body class="has-sidebar single-comment nav-open"><div style="overflow:hidden">one</div></body></html>',
        '<html class="nav-open"><body><article id="related-work"><p class="overflow-hidden">two</p></article><footer>f</footer></body></html>',
        '<body><div aria-hidden="false" title="hidden">three</div><p hidden>no</p><p aria-hidden="true">no</p><p HIDDEN="">no</p></body>',
        '<body><div class="page header-fixed"><p>four</p></div></body>',
        '<body><main><p>five</p><div class="sidebar">no</div></main></body>',
    ]
    rows = [(i, f"http://h{i}/", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in template.main_texts(session.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "one", 1: "two", 2: "three", 3: "four", 4: "five"}


def test_reply_order(session):
    rows = [
        (1, 0, "user", "Hello  world\nsecond line"),
        (1, 1, "assistant", "An answer"),
        (1, 2, "user", "> hello world second line\nI disagree"),
        (1, 3, "user", "> > Hello world\n> an   answer\nok"),
        (2, 0, "user", "> An answer\nelsewhere"),
        (2, 1, "user", None),
        (3, 5, "user", "> unknown\nalone"),
        (None, 1, "user", "lost"),
    ]
    got = {(r.conv_id, r.turn): r for r in reply_ordered(session.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: (r.reply_conv, r.reply_turn, r.thread_conv, r.thread_turn, r.depth) for k, r in got.items()} == {
        (1, 0): (None, None, 1, 0, 0),
        (1, 1): (1, 0, 1, 0, 1),
        (1, 2): (1, 0, 1, 0, 1),
        (1, 3): (1, 1, 1, 0, 2),
        (2, 0): (1, 1, 1, 0, 2),
        (2, 1): (2, 0, 1, 0, 3),
        (3, 5): (None, None, 3, 5, 0),
        (None, 1): (None, None, None, 1, 0),
    }
    assert got[1, 3].text == "ok" and got[1, 3].n_quotes == 2 and got[1, 3].n_linked == 2 and got[3, 5].n_linked == 0


def test_reply_order_links_to_later_conversations_and_breaks_cycles(session):
    rows = [
        (1, 0, "user", "> only there\nfirst"),
        (2, 0, "user", "nothing"),
        (2, 1, "user", "only there"),
        # a cycle of four: each first turn quotes the other conversation's second
        (3, 0, "user", "> yes four\na"),
        (3, 1, "user", "yes three"),
        (4, 0, "user", "> yes three\nb"),
        (4, 1, "user", "yes four"),
        (4, 2, "user", "leads to the cycle"),
        # said later in the own conversation, earlier in a later one
        (5, 0, "user", "> common words\nc"),
        (5, 1, "user", "common words"),
        (6, 0, "user", "common words"),
    ]
    got = {(r.conv_id, r.turn): r for r in reply_ordered(session.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: (r.reply_conv, r.reply_turn, r.thread_conv, r.thread_turn, r.depth) for k, r in got.items()} == {
        (1, 0): (2, 1, 2, 0, 2),
        (2, 0): (None, None, 2, 0, 0),
        (2, 1): (2, 0, 2, 0, 1),
        (3, 0): (None, None, 3, 0, 0),
        (3, 1): (3, 0, 3, 0, 1),
        (4, 0): (3, 1, 3, 0, 2),
        (4, 1): (4, 0, 3, 0, 3),
        (4, 2): (4, 1, 3, 0, 4),
        (5, 0): (6, 0, 6, 0, 1),
        (5, 1): (5, 0, 6, 0, 2),
        (6, 0): (None, None, 6, 0, 0),
    }
    assert got[1, 0].n_linked == got[3, 0].n_linked == got[4, 0].n_linked == got[5, 0].n_linked == 1


def test_repeated_passages(session):
    rng = np.random.default_rng(4)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    shared = words(80)
    fuzzy = shared[:30] + ["extra"] + shared[30:50] + ["other"] + shared[51:]
    short = words(30)
    rows = [(10, words(100) + shared + words(20) + short), (20, fuzzy + words(50)), (30, short + words(40)), (40, shared), (50, [])]
    found = passages.repeated_passages(docs(session, [(d, " ".join(w)) for d, w in rows] + [(None, "x"), (60, None)])).collect()
    got = {(r.doc_id, r.first_word, r.n_words, r.of_doc_id, r.of_first_word) for r in found}
    assert got == {(20, 0, 81, 10, 100), (40, 0, 80, 10, 100)}


def test_repeated_passages_of_parts_first_seen_elsewhere(session):
    rng = np.random.default_rng(7)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    rows, want = [], set()
    for i in range(40):
        one, two = words(30), words(30)
        rows += [(1000 + i, words(20) + one + words(20)), (2000 + i, two + words(30)), (3000 + i, words(40) + one + two + words(9)), (4000 + i, words(11) + one + two + words(40))]
        want.add((4000 + i, 3000 + i))
    parts = [words(20) for _ in range(3)]  # the first two and the last two together in earlier texts
    rows += [(100, words(9) + parts[0] + parts[1]), (101, parts[1] + parts[2] + words(9)), (102, words(5) + sum(parts, []) + words(5)), (103, sum(parts, []))]
    found = passages.repeated_passages(docs(session, [(d, " ".join(w)) for d, w in rows])).collect()
    got = {(r.doc_id, r.of_doc_id) for r in found if r.n_words >= 60}
    assert got == want | {(103, 102)}


def test_repeated_passages_recall(session):
    rng = np.random.default_rng(8)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    rows, at = [], {}
    for k, every in enumerate((20, 14, 10, 7)):  # one changed word of so many, evenly: 95, 93, 90 and 86 %
        for i in range(25):
            shared, doc = words(60), 1000 * k + 2 * i
            changed = [f"c{rng.integers(10**6)}" if j % every == every // 2 else w for j, w in enumerate(shared)]
            rows += [(doc, words(30) + shared + words(30)), (doc + 1, words(20) + changed + words(20))]
            at[doc + 1] = k
    for k, share in enumerate((0.85, 0.8), 4):  # changed words at random places
        for i in range(25):
            shared, doc = words(100), 1000 * k + 2 * i
            changed = [w if rng.random() < share else f"c{rng.integers(10**6)}" for w in shared]
            rows += [(doc, words(30) + shared + words(30)), (doc + 1, words(20) + changed + words(20))]
            at[doc + 1] = k
    found = passages.repeated_passages(docs(session, [(d, " ".join(w)) for d, w in rows])).collect()
    got = {r.doc_id for r in found if r.of_doc_id == r.doc_id - 1 and r.similarity >= 0.75}
    recall = [sum(d in got for d, j in at.items() if j == k) / 25 for k in range(6)]
    assert recall[:4] == [1, 1, 1, 1] and min(recall[4:]) >= 0.9, recall


def test_mixing_meets_targets(session):
    # equal texts are learned from once: many distinct texts
    texts = [(i, f"good fine {'nice' if i % 2 else 'well'} day n{i}") for i in range(600)] + [(1000 + i, f"bad *** awful $$$ n{i}") for i in range(300)] + [(2000, None)]
    labelled = session.createDataFrame([(i, "g") for i in range(0, 600, 2)] + [(1000 + i, "b") for i in range(0, 300, 2)] + [(7, None)], "doc_id long, domain string")
    got = mixed(docs(session, texts), labelled, {"g": 0.8, "b": 0.2}).collect()
    total = [sum(r.mix_tokens * r.mix_rate * r.mix_posteriors[k] for r in got) for k in (0, 1)]
    assert all(r.mix_rate >= 0 for r in got) and abs(total[0] / sum(total) - 0.2) < 0.02
    assert {r.mix_rate for r in mixed(docs(session, texts), labelled.limit(0), {}).collect()} == {1.0}


def test_pipeline_stages(session):
    columns = session.read.parquet(f"{SF}/documents.parquet").columns
    frame = session.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(session, frame, SF)
        assert after.columns == columns
        assert after.select("doc_id").subtract(frame.select("doc_id")).count() == 0
        frame = after
    kept = [r.asDict() for r in frame.select("doc_id", "text").collect()]
    rows = [tuple(r) for r in corpus_pipeline.run(session, SF).collect()]
    assert sorted(r[0] for r in rows) == sorted(k["doc_id"] for k in kept)
