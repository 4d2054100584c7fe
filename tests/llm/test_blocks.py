"""Pages on which a name or an unclosed element must not take the whole text."""

import pytest

from shelfmark.llm import blocks

TEXT = ["The river rose again in the night and the lower fields stood under water by the morning.",
        "Nobody in the village could remember such a spring, and the old bridge was closed for weeks.",
        "When the water fell at last the farmers found stones from the hills lying between the rows."]
RUNNING = "".join(f"<p>{t}</p>" for t in TEXT)
MENU = "<ul><li><a href=/>Home</a><li><a href=/a>About</a></ul>"
FOOTER = "<footer><p>All rights are reserved by the valley paper.</p></footer>"
ASIDE = "<div class=sidebar><p>Follow us for more stories about the valley and its people.</p></div>"


@pytest.mark.parametrize("page", [
    f'<body class="no-sidebar">{RUNNING}</body>',
    f'<body class="page search"><nav>{MENU}</nav>{RUNNING}{ASIDE}</body>',
    f'<div class="layout sidebar-left">{RUNNING}</div>',
    f'<body><nav>{MENU}</nav><div class="layout sidebar-left">{RUNNING}{ASIDE}</div></body>',
    f'<body><div class="search-results">{RUNNING}</div></body>',
    f'<body><div class="promo"><div class="content">{RUNNING}</div></div></body>',
    f'<body><form id="aspnetForm"><nav>{MENU}</nav><div>{RUNNING}</div></form></body>',
    f'<section class="widget"><table class="alert"><tr><td>{RUNNING}</table></section>'])
def test_a_name_on_a_wrapper_does_not_take_the_text(page):
    assert blocks.main_text(page + FOOTER) == "\n".join(TEXT)


@pytest.mark.parametrize("kept_out", [
    ASIDE, f"<div class=comments><div class=content>{'<p>I was there too and saw it all.</p>' * 20}</div></div>",
    "<div class=sidebar><div class=text><p>Follow us for more stories about the valley.</p></div></div>",
    f"<div hidden>{'<p>Nothing of this is ever shown to a reader.</p>' * 20}</div>",
    "<footer><div class=content><p>All rights are reserved by the valley paper.</p></div></footer>"])
def test_marked_parts_beside_the_text_stay_out(kept_out):
    for page in (f"<body><article>{RUNNING}</article>{kept_out}", f"<body><div class=content>{RUNNING}</div>{kept_out}"):
        assert blocks.main_text(page) == "\n".join(TEXT)


def test_a_long_sidebar_beside_an_article_stays_out():
    long = "<div class=sidebar>" + "<p>Follow us for more stories about the valley and its people.</p>" * 30
    assert blocks.main_text(f"<article>{RUNNING}</article>{long}</div>") == "\n".join(TEXT)


@pytest.mark.parametrize("name", "select svg object video noscript template canvas audio".split())
def test_an_unclosed_element_ends_with_its_parent(name):
    for begin in (f"<div><{name}><b>x</b></div>", f"<p><{name} a=1>x</p>",
                  f"<div><{name}><div>x</div><!-- </div> --><script>'</div>'</script></div>"):
        assert blocks.main_text(f"<body>{begin}<article>{RUNNING}</article>") == "\n".join(TEXT)
        later = f"<{name}>y</{name}>"
        assert blocks.main_text(f"<body>{begin}<article>{RUNNING}{later}</article>") == "\n".join(TEXT)
    nested = f"<div><{name}><{name}>x</{name}>y</{name}></div>"
    assert blocks.main_text(f"<body>{nested}<article>{RUNNING}</article>") == "\n".join(TEXT)
