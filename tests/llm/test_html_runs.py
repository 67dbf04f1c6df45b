"""Runs that pages of a host share, over the joined blocks of each page."""

import random

import pytest

MENU = "".join(f"<li>{w}</li>" for w in "Home News Sport Money Travel Food Music Film Books".split())
FOOT = "<div>Copyright Example Inc</div><div>All rights reserved</div><div>Contact us today</div>"


def test_menus_and_footers_of_short_blocks_are_found(llm):
    from milepost.llm.html_text import main_text

    own = ["alpha beta gamma", "The most of it", "The most else"]
    rows = [(i, f"http://a.example/{i}", f"<ul>{MENU}</ul><p>{t}</p>{FOOT}") for i, t in enumerate(own)]
    rows += [(9, "http://b.example/", rows[0][2]), (10, "http://a.example/0", rows[0][2])]  # another host, an equal page
    got = {r["page_id"]: r["text"].split("\n\n") for r in main_text(llm.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {i: got[i] for i in range(3)} == {i: [t] for i, t in enumerate(own)} and got[10] == got[0]
    assert len(got[9]) == 13


def brute(pages, run):
    """Places of each page where a run starts that another page of its host has."""
    seen = {}
    for host, page, tokens in pages:
        for i in range(len(tokens) - run + 1):
            seen.setdefault((host, *tokens[i : i + run]), set()).add(page)
    out = {(h, p): sorted(i for i in range(len(t) - run + 1) if len(seen[h, *t[i : i + run]]) > 1) for h, p, t in pages}
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("parts,rows", [(1, 10_000), (7, 10_000), (40, 3)])
def test_runs_equal_brute_force(llm, parts, rows):
    """Also with groups that span several ranges and several batches."""
    from milepost.llm.html_text import repeated_runs

    rng = random.Random(parts)
    pages = [(f"h{i % 3 and 1}", i, [rng.choice("ab") for _ in range(rng.randrange(1, 30))] + ["c"] * rng.randrange(12)) for i in range(80)]
    before = {k: llm.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for key, value in zip(before, (parts, "false", rows), strict=True):
            llm.conf.set(key, value)
        df = llm.createDataFrame([(h, p, [" ".join(t[:3]), *t[3:]]) for h, p, t in pages], "host string, page long, texts array<string>")
        got = {(r["host"], r["page"]): sorted(r["covered"]) for r in repeated_runs(df, 4).collect()}
    finally:
        for key, value in before.items():
            llm.conf.set(key, value)
    assert got == brute(pages, 4)


def test_blocks_beside_an_article_are_judged_by_the_host(llm):
    """What other pages do not have stays; a host with one page has nothing to judge by."""
    from milepost.llm.html_text import main_text

    rows = [(i, f"http://a.example/{i}", f"<ul>{MENU}</ul><p>Lead {t}</p><article><p>{t}</p></article>{FOOT}<p>More {t}</p>") for i, t in enumerate(["one", "two"])]
    rows += [(9, "http://b.example/", rows[0][2]), (3, "http://a.example/3", "<article>only</article>")]
    got = {r["page_id"]: r["text"] for r in main_text(llm.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {0: "Lead one\n\none\n\nMore one", 1: "Lead two\n\ntwo\n\nMore two", 9: "one", 3: "only"}
