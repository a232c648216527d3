"""Pages whose dropped elements or head are not closed, or only look like others."""

from __future__ import annotations

import pytest

from stayscope.llm.html_extraction import Page

REST = "<p>one</p><p>two</p>"
PAGES = {
    '<svg class="i"/>' + REST: ["one", "two"],
    "<p>a<svg viewBox='0 0 1 1'/>b</p>" + REST: ["ab", "one", "two"],
    "<svg><title/><path d=x /><text>no</text></svg>" + REST: ["one", "two"],
    "<svg><foreignObject><p>no</p></foreignObject></svg>" + REST: ["one", "two"],
    "<svg><path d=x>" + REST + "<script>x = '<p>no</p>'</script>": ["one", "two"],
    "<svg class=a/>no" + REST: ["one", "two"],
    "<select><option>no<option>no" + REST: ["one", "two"],
    "<div><button>no</div>zero" + REST + "<button>no</button>": ["zero", "one", "two"],
    "<button>no" + REST + "<button>no</button>three": ["one", "two", "three"],
    "<noscript><img src=x>" + REST: ["one", "two"],
    "<object data=x>" + REST: ["one", "two"],
    "<iframe src=x>" + REST: ["one", "two"],
    "<button-group>" + REST + "</button-group>three": ["one", "two", "three"],
    "<select-box>zero</select-box><title-bar>" + REST: ["zero", "one", "two"],
    "<style.x>" + REST: ["one", "two"],
    "<button>no<p>no</p><button>no</button></button>" + REST: ["one", "two"],
    "<noscript><p>no</p></noscript><template><div>no</div></template>" + REST: ["one", "two"],
    "<p>a<button>no</button>b<select><option>no</select>c</p>": ["abc"],
    "<html><head><title>no</title><meta charset=x><link rel=y>" + REST: ["one", "two"],
    "<html><head><title>no</title>zero" + REST: ["zero", "one", "two"],
    "<html><head><noscript><link></head>zero" + REST: ["zero", "one", "two"],
    "<html><head> <script>no</script> <style>no</style> </head> <body>" + REST: ["one", "two"],
    "<head><title>no</title><body>" + REST: ["one", "two"],
    REST + "<script>no<p>no": ["one", "two"],
    REST + "<textarea>no<p>no</textarea >three": ["one", "two", "three"],
}


@pytest.mark.parametrize("source", PAGES)
def test_nothing_else_is_dropped(source):
    assert [text for _, text in Page(source).blocks] == PAGES[source]


def test_many_tags_that_are_never_closed():
    page = Page("<p><button>no<svg>no<li>x" * 20_000)
    assert [text for _, text in page.blocks] == ["x"] * 20_000
