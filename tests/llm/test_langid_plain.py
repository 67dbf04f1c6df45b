"""Language ID against plain sets of n-grams, with no filters and no numpy."""

import random
from collections import Counter

import pytest

WORDS = {"en": "the of and ing tion this with here", "de": "der die und ung keit schön über the", "fr": "le les des que eau être ça la"}


def plain_grams(text):
    """Four-byte windows without a double space over the lower-cased, framed bytes."""
    raw = (text or "").encode()
    letters = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in raw)
    framed = b" " + letters + b" "
    return [framed[i : i + 4] for i in range(len(framed) - 3) if b"  " not in framed[i : i + 4]]


def plain(train, texts, least=2e-6, against=0.2):
    counts, rows = {}, Counter()
    for text, lang in train:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
            rows[lang] += 1
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for own in share.values():
        for g, s in own.items():
            best[g] = max(best[g], s)
    sets = {lang: {g for g, s in own.items() if s >= least and s >= against * best[g]} for lang, own in share.items()}
    order = sorted(sets, key=lambda lang: (-rows[lang], lang))
    out = []
    for text in texts:
        if not any(map(str.isalpha, text or "")):
            out.append(("und", 0.0))
            continue
        grams = plain_grams(text)
        scores = [sum(g in sets[lang] for g in grams) / len(grams) if grams else 0.0 for lang in order]
        top = max(range(len(order)), key=lambda i: (scores[i], -i))
        out.append((order[top], scores[top]))
    return out


def test_predictions_equal_plain_sets(llm):
    from milepost.llm import langid

    rng = random.Random(6)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))
    train = [(text(lang, rng.randrange(1, 30)), lang) for lang in [*WORDS, "en", "fr"] for _ in range(25)]
    train += [train[0]] * 30 + [(None, "de"), ("", "fr"), ("unlabelled words", None)]
    asked = [text(lang, n) for lang in WORDS for n in (1, 2, 5, 40)] + [text("en", 5) + " " + text("de", 6), "QQQ zzz", "a", "12 34", None, "", "日本語", "The THE the!"]
    asked += [text("fr", 300_000), asked[0], asked[0]]  # longer than what is handled at once; repeated rows
    fit = langid.fit(llm.createDataFrame(train, "text string, lang string").repartition(4))
    got = langid.predict(llm.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(3), fit).collect()
    for r, (lang, score) in zip(sorted(got, key=lambda r: r["doc_id"]), plain(train, asked), strict=True):
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-6), asked[r["doc_id"]][:40]
