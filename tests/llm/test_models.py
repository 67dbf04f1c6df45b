"""Language ID, language model, sharding, search and page text."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

LOWER = {i: i + 32 for i in range(65, 91)}


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


LANGS = {"en": "the of and ing tion this with", "de": "der die und ung keit schön über", "fr": "le les des que eau être ça"}


@pytest.fixture
def labelled(llm):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(240):
        lang = [*LANGS][i % 3]
        rows.append((i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(25)), lang, lang))
    rows += [(900, None, "en", "x"), (901, "", None, "x"), (902, "12 !! 34", "en", "x"), (903, "the and this", None, "x"), (904, "日本語", None, "x")]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)


def test_held_out_languages_are_found(labelled, nothing):
    from milepost.llm import langid

    docs = labelled.withColumn("held_out", langid.held_out("doc_id"))
    filters = langid.fit(docs.where("NOT held_out"))
    rows = {r["doc_id"]: r for r in langid.predict(docs, filters).collect()}
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert all(rows[i]["lang_pred"] == rows[i]["lang"] for i in range(240))
    assert [(rows[i]["lang_pred"], rows[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert rows[903]["lang_pred"] == "en" and rows[904]["lang_pred"] in LANGS
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    untrained = langid.fit(nothing)
    assert {r["lang_pred"] for r in langid.predict(docs, untrained).collect()} == {"und"}
    assert langid.predict(nothing, filters).count() == 0


def test_grams_stay_within_their_row():
    from milepost.llm import langid

    data = b"abcd" + b"" + b"e" + b"fg  hi"
    g, n = langid.grams(np.frombuffer(data, np.uint8), np.array([0, 4, 4, 5, 11]))
    text = [int(x).to_bytes(4, "big").decode() for x in g]
    assert text == [" abc", "abcd", "bcd ", " fg ", " hi "] and n.tolist() == [3, 0, 0, 2]


def test_filters_hold_more_than_64_languages():
    from milepost.llm import langid

    table = np.zeros((2, 1 << 10), np.uint64)
    gram = np.array([7, 8], np.uint32)
    at = langid.slots(gram, 1 << 10)
    table[1, at[:, 0]] |= np.uint64(2)
    shares = langid.Filters([f"l{i:02}" for i in range(66)], table).shares(gram, np.array([2]))
    assert shares[0].argmax() == 65 and 0.4 < shares[0, 65] <= 0.5


def brute_base(rows):
    counts, doc = Counter(), {}
    for i, t in rows:
        doc[i] = [*words(t), "\n"]
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(doc[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in doc.items()}


@pytest.mark.parametrize("head", [1 << 18, 5])
def test_base_scores_equal_brute_force(llm, texts, monkeypatch, head):
    """With a small head, counts of rarer words come by the join."""
    from milepost.llm import lm

    monkeypatch.setattr(lm, "HEAD", head)
    rows = list(enumerate(texts))
    got = lm.log_likelihoods(llm.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(3)).collect()
    expected = brute_base(rows)
    assert len(got) == len(rows)
    for r in got:
        e = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:4]
        assert r["base_score"] == pytest.approx(e[4], rel=1e-9) and math.isfinite(r["score"]) and r["score"] < 0


def test_model_beats_counts_on_held_out_rows(llm, nothing):
    import random

    from milepost.llm import lm

    rng = random.Random(4)
    nxt = {f"w{i}": [f"w{(i * 5 + k) % 40}" for k in range(3)] for i in range(40)}
    rows = []
    for i in range(600):
        w, out = "w0", []
        for _ in range(60):
            w = rng.choice(nxt[w])
            out.append(w)
        rows.append((i, " ".join(out)))
    got = lm.log_likelihoods(llm.createDataFrame(rows, "doc_id long, text string").repartition(2)).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"] * 0.9
    assert lm.log_likelihoods(nothing).count() == 0


def test_gradients_of_the_model():
    """Backpropagation through a window against differences."""
    from milepost.llm import lm

    rng = np.random.default_rng(0)
    flat = (rng.standard_normal(lm.Gru.SIZE) * 0.3).astype(np.float64)
    model, grads = lm.Gru(flat), lm.Gru(np.zeros(lm.Gru.SIZE))
    x, y = rng.integers(0, 50, (5, 3)), rng.integers(0, 50, (5, 3))
    mask = np.ones((5, 3), bool)
    mask[3:, 2] = False
    h = rng.standard_normal((3, lm.HIDDEN)) * 0.1
    model.window(x, y, mask, h, grads)
    for name in ("inp", "rec", "wc", "bc", "wo", "bo"):
        g, w = getattr(grads, name).ravel(), getattr(model, name).ravel()
        i = int(np.abs(g).argmax())
        old = w[i]
        w[i] = old + 1e-2
        up = -model.window(x, y, mask, h, None)[0].sum()
        w[i] = old - 1e-2
        down = -model.window(x, y, mask, h, None)[0].sum()
        w[i] = old
        assert g[i] == pytest.approx((up - down) / 2e-2, rel=2e-2), name


def test_probabilities_sum_to_one_and_windows_carry_the_state():
    from milepost.llm import lm

    rng = np.random.default_rng(1)
    model = lm.Gru((rng.standard_normal(lm.Gru.SIZE) * 0.2).astype(np.float32))
    h = rng.standard_normal((1, lm.HIDDEN)).astype(np.float32)
    logs, _ = model.log_probs(np.repeat(h, lm.ENTRIES, 0), np.arange(lm.ENTRIES))
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    entries, counts = rng.integers(0, 100, 300), np.array([130, 1, 100, 69])
    together = lm.log_likelihood(model, entries, counts, 0)
    at = np.concatenate(([0], np.cumsum(counts)))
    for i in range(4):
        own = entries[at[i] : at[i + 1]]
        state, total = np.zeros((1, lm.HIDDEN), np.float32), 0.0
        for before, now in zip([0, *own[:-1]], own, strict=True):
            logp, state = model.window(np.array([[before]]), np.array([[now]]), np.ones((1, 1), bool), state, None)
            total += float(logp[0])
        assert together[i] == pytest.approx(total / math.log(10), rel=1e-4)


def test_shards_are_a_permutation(documents, texts, nothing):
    from milepost.llm.sharding import feistel, shards

    for n in (1, 2, 3, 16, 17, 1000):
        assert sorted(feistel(np.arange(n), n, 5)) == list(range(n))
    assert feistel(np.arange(100), 100, 1).tolist() != feistel(np.arange(100), 100, 2).tolist()
    got = shards(documents).collect()
    assert [tuple(r) for r in sorted(shards(documents.repartition(7)).collect())] == [tuple(r) for r in sorted(got)]
    assert len(got) == len(texts) + 2
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    # The place follows from the number alone: rows in the order of their ids.
    order = sorted(got, key=lambda r: r["doc_id"])
    place = feistel(np.arange(len(got)), len(got))
    unique = [i for i, r in enumerate(order) if sum(x["doc_id"] == r["doc_id"] for x in got) == 1]
    assert all((order[i]["shard"], order[i]["slot"]) == (place[i] % 16, place[i] // 16) for i in unique)
    assert shards(nothing).count() == 0


def brute_search(rows, k):
    docs = [(i, Counter(words(t))) for i, t in rows]
    n, mean = len(docs), sum(sum(c.values()) for _, c in docs) / len(docs)
    df = Counter(t for _, c in docs for t in c)
    out = {}
    for q, query in docs:
        if q % 100:
            continue
        scores = []
        for i, c in docs:
            s = sum(m * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for t, m in query.items() if t in c)
            if s > 0:
                scores.append((-round(s, 7), i))
        out[q] = sorted(scores)[:k]
    return {q: v for q, v in out.items() if v}


@pytest.mark.parametrize("shard,terms", [(16 << 20, 2_000_000), (2000, 40)])
def test_search_equals_brute_force(llm, monkeypatch, nothing, shard, terms):
    """Also with many shards and several blocks of queries."""
    import random

    from milepost.llm import topk

    monkeypatch.setattr(topk, "QUERY_TERMS", terms)
    monkeypatch.setattr(topk, "SHARD_BYTES", shard)
    monkeypatch.setattr(topk, "BLOCK", 4)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 97}" for _ in range(rng.randrange(1, 30)))) for i in range(500)]
    rows += [(500, None), (600, ""), (700, rows[3][1]), (701, rows[3][1])]
    df = llm.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(4)
    got = {}
    for r in topk.search(df, df.where("doc_id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-round(r["score"], 7), r["doc_id"]))
    assert got == brute_search(rows, 10)
    assert topk.search(nothing, nothing).count() == 0


PAGES = [
    (1, "http://a.example/1", "<html><head><title>t</title><style>p{}</style></head><body><nav><a>Home</a></nav><article><h1>Head</h1><p>One &amp; two<br>three</p><p>x <b>y</b>z</p><script>var a='<p>'</script></article><aside>S</aside><footer>F</footer>", "Head\n\nOne & two three\n\nx yz"),
    (2, "http://a.example/2", "<div class='menu'>m1 m2</div><div><p>alpha beta</p><form>q</form><p>gamma</p></div><div id='comments'><p>bad</p></div>", "alpha beta\n\ngamma"),
    (3, "http://b.example/1", "<p>sign up for our great news letter today folks</p><p>own words here</p>", "own words here"),
    (4, "HTTP://B.example:80/2", "<p>sign up for our great news letter today folks</p><p>other text</p>", "other text"),
    (5, "http://c.example/1", "<p>sign up for our great news letter today folks</p>", "sign up for our great news letter today folks"),
    (6, None, None, ""), (7, "", "", ""), (8, "nonsense", "plain text <a href='x", "plain text"),
    (9, "http://d.example", "<main><header><h1>T</h1></header><p>a<p>b<aside>no</aside><div class='cookie-notice'>no</div><article class='comment'>no</article></main>tail", "T\n\na\n\nb"),
    (10, "http://e.example", "<p>start sign up for our great news letter today folks end</p><p>sign up for our great news letter today folks</p>", "start sign up for our great news letter today folks end\n\nsign up for our great news letter today folks"),
]


def test_main_text_of_pages(llm):
    from milepost.llm.html_text import main_text

    df = llm.createDataFrame([(i, u, h, "x", 1) for i, u, h, _ in [*PAGES, PAGES[0]]], "page_id long, url string, html string, text string, page int").repartition(3)
    got = main_text(df).collect()
    assert len(got) == len(PAGES) + 1
    for r in got:
        _, url, _, text = PAGES[r["page_id"] - 1]
        assert (r["url"], r["text"], r["n_chars"]) == (url, text, len(text))
    assert main_text(df.limit(0)).count() == 0


def test_components_of_chains(llm):
    from milepost.llm.components import components

    links = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (200, 300)]
    got = {tuple(r) for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(1, 41)} | {(90, 90), (95, 90), (100, 90), (200, 200), (300, 200)}
