"""Small pages with labelled blocks, from which the block classifier is trained.

The first character of each block's text is its label: ``+`` main text, ``-`` anything else. The pages vary what sites
vary: with and without an article element, with speaking and with meaningless class names, wrapped as a whole in a form or
in a container whose name sounds like boilerplate, with short and with long articles, menus, notices and comments.
"""

from __future__ import annotations

_WORDS = "river stone winter letter garden morning travel under bright window silver market common paper night young over field story rather".split()


def _say(n: int, label: str = "+", step: int = 3) -> str:
    """A sentence of n words."""
    return label + " ".join(_WORDS[(i * step + n) % len(_WORDS)] for i in range(n)) + "."


def _menu(n: int, words: int = 1) -> str:
    return "".join(f'<li><a href="/{i}">-{" ".join(_WORDS[i : i + words])}</a></li>' for i in range(n))


def _paragraphs(*sizes: int, label: str = "+") -> str:
    return "".join(f"<p>{_say(n, label, 3 + k)}</p>" for k, n in enumerate(sizes))


def _comments(*sizes: int) -> str:
    return "".join(f'<div class="comment"><span>-{_WORDS[k]} says</span><p>{_say(n, "-", 7)}</p></div>' for k, n in enumerate(sizes))


PAGES = [
    # an article element with everything around it
    f"<header><h2>-Site name</h2></header><nav><ul>{_menu(5)}</ul></nav><div class=ad>{_say(9, '-')}</div><article><h1>+Of rivers</h1>{_paragraphs(40, 3, 61, 12)}</article><aside class=sidebar>{_say(25, '-')}</aside><footer>{_say(14, '-')}</footer>",
    f"<nav><ul>{_menu(6)}</ul></nav><div class=ad>{_say(11, '-')}</div><article><h1>+Short</h1><p>+Brief words.</p></article><footer>{_say(16, '-')}</footer>",
    f"<nav><ul>{_menu(4)}</ul></nav><div class=ad>{_say(6, '-')}</div><article><h1>+Title</h1>{_paragraphs(5)}</article><footer>{_say(12, '-')}</footer>",
    f"<nav><ul>{_menu(3, 2)}</ul></nav><main><h1>+Long one</h1>{_paragraphs(120, 80, 7, 240, 55)}<ul><li>+first</li><li>+second thing</li></ul></main><footer>{_say(30, '-')}</footer>",
    # boilerplate inside of an article
    f"<article><header><h1>+Inside</h1></header>{_paragraphs(30)}<aside>{_say(8, '-')}</aside>{_paragraphs(44)}<form><label>-Mail</label><button>-Send</button></form><div class='share-buttons'><a href=x>-Share</a></div><footer>{_say(7, '-')}</footer></article>",
    f"<article><h1>+With notes</h1>{_paragraphs(50, 22)}<div class=notice>{_say(13, '-')}</div>{_paragraphs(35)}<section id=comments><h3>-Comments</h3>{_comments(12, 31)}</section></article>",
    f"<article><h2>+More comments than text</h2>{_paragraphs(26)}</article><section id=comments><h3>-Readers</h3>{_comments(20, 44, 61, 18)}</section>",
    f"<article><div class='related-posts'><h4>-Related</h4><ul>{_menu(3, 4)}</ul></div><h1>+Below</h1>{_paragraphs(33, 2, 19)}</article><div class=cookie-notice>{_say(21, '-')}</div>",
    # a container whose own name sounds like boilerplate, or which is a form, holds the page
    f"<div class='entry-content share-target'><h1>+Held</h1>{_paragraphs(60, 4, 31)}<div class=share><a href=x>-Tell a friend</a></div></div><div class=footer>{_say(9, '-')}</div>",
    f"<form><div id=menu>{_menu(4)}</div><article class='search result'><h1>+Form page</h1>{_paragraphs(70, 25)}</article><div class=footer>{_say(8, '-')}</div></form>",
    f"<div class=widget><h1>+Widget page</h1>{_paragraphs(45, 38, 9)}</div><div class=sidebar><p>{_say(15, '-')}</p></div>",
    f"<article class='post ad'><h1>+Odd name</h1>{_paragraphs(27, 3, 48)}</article><nav>{_menu(3)}</nav>",
    # speaking names without an article element
    f"<div id=menu>{_menu(5)}</div><div class=post-content><h1>+Plain div</h1>{_paragraphs(64, 1, 23)}</div><div class=related><a href=z>-See also</a></div><div class=footer>{_say(6, '-')}</div>",
    f"<div class=content><h2>+Tiny</h2><p>+One.</p><p>{_say(7)}</p></div><div class=promo>{_say(17, '-')}</div><div class=copyright>{_say(5, '-')}</div>",
    f"<ul class=menu>{_menu(7)}</ul><div class=story><p>{_say(90)}</p><p>+Yes.</p></div><div class=comments>{_comments(15, 9)}</div>",
    # nothing but text and links to go by
    f"<div><a href=a>-one</a> <a href=b>two</a></div><div><h1>+Bare</h1>{_paragraphs(52, 41)}</div><div>-contact us</div>",
    f"<table><tr><td><a href=a>-home</a></td><td><a href=b>-about us</a></td></tr></table><p>{_say(75)}</p><p>{_say(6)}</p><p>{_say(48)}</p><div><a href=c>-next page of this</a></div>",
    f"<div><a href=a>-start</a></div><p>{_say(36)}</p><p>+{'linked '}<a href=q>words here</a> {_say(28, '')}</p><p>{_say(31)}</p><div>-all rights</div>",
    f"<p>{_say(60)}</p>",
    f"<div>-search here</div><div>-log in</div><h1>+Head</h1><div>{_say(130)}</div><div>{_say(9)}</div><div>{_say(85)}</div><div>-terms</div><div>-privacy</div>",
    f"<div>-menu</div><div><a href=a>-first of all links</a></div><div><a href=b>-second of the links</a></div><div>{_say(24)}</div><div>{_say(29)}</div><div><a href=c>-{' '.join(_WORDS[:12])}</a></div>",
    # articles of a block or two, and of short blocks
    f"<article><p>{_say(5)}</p></article>",
    f"<div data-id=ad><article><p>{_say(8)}</p></article></div><footer>{_say(11, '-')}</footer>",
    f"<nav><ul>{_menu(5)}</ul></nav><article><h1>+One</h1></article><footer>{_say(9, '-')}</footer>",
    f"<article><p>+Yes</p><p>+no stop here</p></article>",
    f"<article><h1>+Lists</h1><ul><li>+alpha</li><li>+beta gamma</li><li>+delta</li></ul><p>+<a href=x>linked all over</a></p><table><tr><td>+cell</td><td>+2</td></tr></table></article><div>-unmarked after</div>",
    f"<article><p><a href=x>+All of it is a link</a></p><p>{_say(4)}</p></article>",
    f"<main><p>{_say(14)}</p><p>+End</p></main>",
    f"<article>+Text without paragraphs</article>",
    f"<article><h3>+Parts</h3>{_paragraphs(9)}<h3>+More parts</h3>{_paragraphs(11, 6)}<h3>+Last part</h3></article>",
    # what stands beside an article, however long and however named
    f"<div>{_say(60, '-')}</div><article><h1>+Beside</h1>{_paragraphs(20, 9)}</article><div>{_say(45, '-')}</div><div>-small</div>",
    f"<p>{_say(33, '-')}</p><h2>-A heading</h2><article>{_paragraphs(80, 12)}</article><div class=content>{_say(28, '-')}</div>",
    f"<div class=ad>{_say(4, '-')}</div><article><h1>+Very long</h1>{_paragraphs(400, 350, 2, 500)}</article><footer>{_say(6, '-')}</footer>",
    f"<div class=ad>-<a href=x>shop</a></div><div class=post>{_paragraphs(300, 420, 380)}<div class=ad>{_say(5, '-')}</div>{_paragraphs(210)}</div>",
    # named containers with short ends
    f"<div class=entry-content><p>{_say(12)}</p><p>{_say(4)}</p></div>",
    f"<div class='entry-content share-ready'><p>{_say(10)}</p><p>+Ends here</p></div>",
    f"<div class=text><h1>+Title alone</h1><p>{_say(6)}</p></div><div>-imprint</div>",
    f"<div class=body-text><p>{_say(22)}</p><ul><li>+item one</li><li>+item two</li></ul></div><div class=login>-Sign in</div>",
    f"<div role=navigation>{_menu(4)}</div><div id=main>{_paragraphs(16, 2)}</div><div role=contentinfo>{_say(10, '-')}</div>",
    # without names
    f"<p>{_say(13)}</p><p>{_say(17)}</p>",
    f"<h1>+A title</h1><p>{_say(42)}</p>",
    f"<div>-home</div><h1>+A title of words</h1><p>{_say(58)}</p><p>{_say(3)}</p><p>{_say(49)}</p><p>-<a href=x>back to top</a></p>",
    f"<ul>{_menu(6)}</ul><p>{_say(88)}</p><ul>{_menu(6, 3)}</ul>",
    # sentences that aren't text, and text that isn't sentences: their neighbours tell
    f"<div>-Call us.</div><div>-Join today.</div><div>+{' '.join(_WORDS * 3)}</div><div>+{' '.join(_WORDS)}</div><div>{_say(66)}</div><div>-Open daily.</div><div>-Ask us.</div>",
    f"<div>-Read more.</div><div>-Log in here.</div><p>{_say(47)}</p><p>+then came spring</p><p>{_say(52)}</p><p>+and nobody knew</p><p>{_say(39)}</p><div>-Up.</div><div>-Terms apply.</div><div>-Contact us.</div>",
    f"<div>-One moment.</div><div>-Please wait.</div><div>-Enjoy.</div><p>+{' '.join(_WORDS * 2)}</p><p>{_say(57)}</p>",
    f"<span>-welcome to the site</span><div>-we are glad</div><h2>+Bare heading</h2><div>+{' '.join(_WORDS * 5)}</div><div>-see you</div><div>-bye now</div>",
    # named containers that hold most of a page, beside much else
    f"<div id=menu>{_menu(12)}</div><div class='widget page'><h1>+Still it</h1>{_paragraphs(45, 20)}</div><div class=footer>{_say(26, '-')}</div>",
    f"<div id=menu>{_menu(10, 2)}</div><article class='banner story'><h1>+Also it</h1>{_paragraphs(35, 24)}</article><div class=sidebar>{_say(22, '-')}</div>",
    f"<nav><ul>{_menu(9, 2)}</ul></nav><div class='comment-page'><p>{_say(41)}</p><p>{_say(19)}</p></div><div class=legal-notice>{_say(24, '-')}</div>",
]
