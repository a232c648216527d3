"""Labelled pages in miniature, for training the page model.

``<y1>`` begins what is content and ``<y0>`` what isn't; everything else is neither. The
pages are put together from the parts below, one container with each surrounding.
"""

from __future__ import annotations

TEXT = (
    "A long and plain sentence of the kind that articles are made of, with commas, and more than one clause.",
    "Short line of the article.",
    "Another paragraph, which quotes somebody at length and then goes on to explain why that matters to the reader of it.",
)
CONTAINERS = (
    "<article>{}</article>",
    "<main>{}</main>",
    "<main><article>{}</article></main>",
    "<div id='content'>{}</div>",
    "<div class='post content'>{}</div>",
    "<div class='article-body'>{}</div>",
    "<section class='entry'>{}</section>",
    "<div class='story text'>{}</div>",
    "<article class='post'><section>{}</section></article>",
    "<div><div>{}</div></div>",
)
BODIES = (
    "<h1>{1}</h1><p>{0}</p><p>{2}</p><p>{1}</p>",
    "<header><h1>{1}</h1></header><p>{0}</p><blockquote><p>{2}</p></blockquote><p>{0}</p>",
    "<h1>{1}</h1><p>{0}</p><h2>{1}</h2><ul><li>{1}</li><li>{0}</li></ul><p>{2}</p>",
    "<h1>{1}</h1><p>{2}</p><table><tr><td>{1}</td><td>{1}</td></tr></table><pre>{0}</pre><p>{1}</p>",
    "<h1>{1}</h1><p>{0}</p><figure><figcaption>{1}</figcaption></figure><div>{2}</div><h3>{1}</h3><ol><li>{0}</li></ol>",
    "<p>{1}</p>",
    "<h1>{1}</h1>",
)
BEFORE = (
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>",
    "<header><div class='logo'>The Site</div><ul class='menu'><li><a href='/a'>Home</a></li></ul></header>",
    "<div class='header'><a href='/'>Site</a></div><div class='navbar navigation'><a href='/x'>One</a> <a href='/y'>Two</a></div>",
    "<div id='header' role='banner'>Site</div><div class='topbar'><a href='/l'>Log in</a></div><nav class='breadcrumb'><a href='/'>Home</a></nav>",
    "<div class='cookie notice banner'><p>We use cookies to make this site work better for you.</p><button>Accept</button></div>",
    "<div class='ad'>Buy now, the very best offers of the week are waiting for you here.</div>",
    "<div class='advert ads sponsor promo'><p>An offer by our sponsor, only this week.</p></div><div role='navigation'><a href='/'>Home</a></div>",
)
AFTER = (
    "<footer>Copyright The Site. All rights reserved.</footer>",
    "<div class='footer'><p>Copyright</p><ul><li><a href='/t'>Terms</a></li></ul></div>",
    "<aside class='sidebar'><h3>Popular</h3><ul><li><a href='/1'>One story</a></li></ul></aside><footer><p>Contact us at any time.</p></footer>",
    "<div class='sidebar widget'><p>Read more of this in the archive.</p><ul><li><a href='/1'>Old</a></li></ul></div><div id='footer'>Imprint</div>",
    "<section class='comments' id='comments'><h2>Comments</h2><div class='comment'><p>I like this article a lot, thank you for writing it.</p></div><div class='comment reply'><p>So do I, but for one thing.</p></div></section>",
    "<div class='related recommended'><h3>More</h3><ul><li><a href='/1'>A further story</a></li></ul></div><div class='share social'><a href='/s'>Share</a></div>",
    "<form class='search newsletter subscribe' action='/s'><p>Sign up for our newsletter</p><label>Name</label><input></form><div class='modal popup notice'><p>Please turn off your ad blocker.</p></div>",
    "<ol class='discussion replies'><li><article class='comment'><p>This is what a reader has to say about it, at some length.</p></article></li></ol><div role='contentinfo'>Copyright</div>",
    "<div class='disclaimer legal notice'><p>Nothing on this page is advice of any kind.</p></div><div class='menu'><a href='/a'>Menu</a></div>",
)


def labelled_pages() -> list[str]:
    """Every container with every body, the surroundings in turn."""
    pages = []
    for i, container in enumerate(CONTAINERS):
        for j, body in enumerate(BODIES):
            n = i * len(BODIES) + j
            around = [BEFORE[n % len(BEFORE)], BEFORE[(3 * n + 1) % len(BEFORE)], AFTER[n % len(AFTER)], AFTER[(2 * n + 1) % len(AFTER)]]
            inside = AFTER[(n + 2) % len(AFTER)] if n % 3 == 0 else ""
            text = container.format(body.format(*TEXT) + (f"<y0>{inside}</y0>" if inside else ""))
            pages.append(f"<html><body><y0>{around[0]}{around[1]}</y0><y1>{text}</y1><y0>{around[2]}{around[3]}</y0></body></html>")
    return pages
