"""Pages that the given data has no example of."""

import pytest

from clickweir.llm.html_extract import main_text

LONG = "The first long paragraph of the page tells its readers at some length what has happened in the town since the last week of the old year."
MORE = "The second one goes on from there and gives the reasons that were put forward by all of the people who were asked about it."


@pytest.mark.parametrize("name", ["svg-icon", "title-bar", "button-group", "object-view", "script-x", "select-box"])
def test_custom_elements_hide_nothing(name):
    page = f"<body><article><p>{LONG}</p><{name} a='b'></{name}><p>{MORE}</p></article></body>"
    assert main_text(page) == f"{LONG}\n\n{MORE}"


@pytest.mark.parametrize(
    "hidden",
    [
        "<datalist><option value=a>one<option value=b>two</datalist>", "<select><option>one<option>two</select>", "<div><button>Buy</div>",
        "<svg><path d='m0'/><title>t</title><g><text>word</text></g></svg>", "<svg><path d='m0'>", "<div><object data=x><embed src=x>plain</div>",
        "<a href=x><svg><path></a>", "<div><button>one<button>two</button></div>", "<noscript><p>Turn it on</noscript>", "<template><div><p>x</template>",
        "<svg><foreignObject><div>in a picture</div></foreignObject></svg>", "<canvas>none</canvas><iframe src=x>none</iframe>", "<textarea><p>x</textarea>", "</button></svg></option>",
    ],
)
def test_hidden_elements_hide_their_own_text_only(hidden):
    assert main_text(f"<body><article><p>{LONG}</p>{hidden}<p>{MORE}</p></article></body>") == f"{LONG}\n\n{MORE}"


def test_text_goes_on_round_hidden_elements():
    page = f"<article><p>{LONG} <b>So</b> <svg><g>x</g></svg>it <button><p>no</p></button>is.</p><p>{MORE}</p></article>"
    assert main_text(page) == f"{LONG} So it is.\n\n{MORE}"
    for name in ("script", "style", "title", "textarea"):
        assert main_text(f"<article><p>{LONG}</p><{name}><p>{MORE}</p></article>") == LONG


@pytest.mark.parametrize(
    "round_it",
    [
        "<div class='layout has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class='sidebar'>{}</div>", "<form id='aspnetForm'>{}</form>",
        "<div title='Hidden gems'>{}</div>", "<div data-hidden='false'>{}</div>", "<div data-class='nav' data-id=menu>{}</div>", "<div class='widget'><form>{}</form></div>",
        "<div aria-hidden='false'>{}</div>", "<div data-x='style=display:none'>{}</div>", "<div class='content-sidebar-wrap'>{}</div>",
    ],
)
def test_articles_in_containers_that_look_like_boilerplate(round_it):
    article = f"<article><h1>A heading of some words</h1><p>{LONG}</p><p>Short.</p><p>{MORE}</p></article>"
    for inner in (article, article.replace("article>", "main>"), article.replace("<article>", "<article title='Hidden gems' data-hidden='false' class='no-comments'>")):
        assert main_text("<body><nav><ul><li><a href=/>Home</a></ul></nav><div>Tuesday, the second of May</div>" + round_it.format(inner) + "</body>") == f"A heading of some words\n\n{LONG}\n\nShort.\n\n{MORE}"


@pytest.mark.parametrize("start", ["<div class='layout has-sidebar'>", "<form id='aspnetForm'>", "<div title='Hidden gems'>", "<div data-hidden=false>"])
def test_pages_without_an_article_element(start):
    page = f"<body>{start}<div><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p></div>"
    assert main_text(page) == f"{LONG}\n\n{MORE}\n\n{LONG}"


@pytest.mark.parametrize(
    "start",
    [
        "<article hidden>", "<article aria-hidden='true'>", "<div style='color:red; display: none'><article>", "<nav><article>", "<section class='comments'><article>",
        "<article class='comment-body'>", "<div class='widget'>", "<div role=navigation>", "<div id='cookie-notice'>", "<div class='x site-footer'>",
    ],
)
def test_boilerplate_stays_out(start):
    assert main_text(f"<body><div>{start}<p>{LONG}</p></div><main><p>{MORE}</p></main>") == MORE
