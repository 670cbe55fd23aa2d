"""Pages whose <article> elements are not the main text."""

from creditmart.llm.html_extraction import main_text

STORY = "<div class='entry'><p>The main text of the page stands in plain boxes.</p><p>It has a second part.</p></div>"
TEXT = "The main text of the page stands in plain boxes. It has a second part."


def text(page):
    return main_text(f"<body><nav>menu</nav>{page}<footer>foot</footer></body>", frozenset())


def test_comments_as_articles():
    one = "<article class='comment-body'><p>A reader says a lot about this, more than the page.</p></article>"
    assert text(f"{STORY}<div class='comments'>{one * 3}</div>") == TEXT
    assert text(STORY + one) == TEXT
    assert text(f"{STORY}<article role='complementary'>Beside it</article>") == TEXT
    assert text(f"<article class='post category-social tag-related'>{STORY}{one}</article><div>after</div>") == TEXT


def test_teasers_as_articles():
    teaser = "<article><h3>Read more</h3></article>"
    assert text(f"{STORY}<aside>{teaser * 2}</aside>") == TEXT
    assert text(f"{STORY}<div>{teaser * 2}</div>").startswith(TEXT)


def test_a_noisy_article_marks_nothing():
    from creditmart.llm import html_extraction as extraction

    page = f"{STORY}<article class='x'>{'The same on all pages. ' * 9}</article>"
    path = next(path for path, _, inside, _ in extraction.blocks(page)[0] if inside)
    assert main_text(page, frozenset([extraction._signed(path)])) == TEXT
