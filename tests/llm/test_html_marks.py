"""Names of elements that mark boilerplate, and those that only look like it."""

import pytest

CASES = [
    ("<div class='layout right-sidebar'><article><p>a</p></article><p>side</p></div>", "a"),
    ("<div class='post comments-open'><article><p>a</p></article></div>", "a"),
    ("<div class='site-header'><main><p>a</p></main></div>", "a"),
    ("<div class='widget'><article class='comment'>no</article><article>a</article></div>", "a"),
    ("<article>a<h2 id='social-impact'>b</h2><section id='related-work'><p>c</p></section><p id='notice-period'>d</p><h3 id='comments'>e</h3></article>", "a b c d e"),
    ("<article>a<div class='related-posts'><article>no</article></div><section id='comments'><article>no</article></section></article>", "a"),
    ("<div class='sidebar'><article>no</article></div><div class='post-comments'><article>no</article></div><main>a</main>", "a"),
    ("<div class='main-menu'>no</div><div class='cookie-notice'>no</div><div role='navigation'>no</div><div class='share-buttons'>no</div><div class='ad-slot-3'>no</div><p>a</p>", "a"),
    ("<nav class='right-sidebar'><article>no</article></nav><p>a</p>", "a"),
    ("<body class='sidebar'><header>no</header><article class='widget'>a</article></body>", "a"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_marks_are_whole_names_or_fixed_compounds(html, text):
    from milepost.llm.html_text import CONTENT, OPEN, blocks

    got = " ".join(t for kind, t in blocks(html) if kind in (CONTENT, OPEN))
    assert got == text
