"""Block reader and labeller on pages labelled by hand: ``{+text}`` is article, ``{-text}`` isn't."""

import re
import time

import numpy as np
import pytest

from laurel.llm import html_blocks as H
from tests.llm.test_others import PAGE

LONG = "It took the crew four days to cross the valley, and by the end nobody spoke of going back."
HAND = [
    "<nav>{-Start}</nav><article><h1>{+Bread at home}</h1><p>{+What you need for one loaf.}</p><ul><li>{+500 g of flour}</li><li>{+Water}</li></ul></article><footer>{-Imprint}</footer>",
    "<div class='menu'><a href=a>{-All news}</a></div><div id='content'><h2>{+Rain again}</h2><div>{+" + LONG + "}</div></div><div class='comments'><p>{-First!}</p><p>{-I was there too.}</p></div>",
    "<article><header><h1>{+A long walk}</h1></header><p>{+" + LONG + "}</p><blockquote>{+Never again, she said.}</blockquote></article><aside>{-Most read}</aside>",
    "<nav><ul><li>{-Docs}</li></ul></nav><main><h1>{+Install}</h1><pre>{+tar xf tool.tar}</pre><p>{+Then start it.}</p></main><footer>{-Terms}</footer>",
    "<nav>{-Home}</nav><article><h2>{+Results}</h2><table><tr><th>{+Team}</th><th>{+Points}</th></tr><tr><td>{+North}</td><td>{+12}</td></tr></table></article><footer>{-Contact us}</footer>",
    "<header class='top'><p>{-The Daily}</p></header><main><article><h1>{+Storm}</h1><figure><img src=x><figcaption>{+The harbour at noon.}</figcaption></figure><p>{+" + LONG + "}</p></article></main>",
    "<article><h1>{+Words}</h1><dl><dt>{+Loaf}</dt><dd>{+A piece of bread.}</dd><dt>{+Crust}</dt><dd>{+Its outside.}</dd></dl></article><footer>{-Write to us}</footer>",
    "<article><p>{+One. two}<button>{-Share}</button></p><p>{+" + LONG + "}</p></article>",
    "<article><h1>{+Ports}</h1><p>{+The harbour opened in May.}</p><div class='ad'>{-Cheap flights}</div><p>{+Ships came at once.}</p></article><footer>{-Legal}</footer>",
    "<div class='cookie-notice'><p>{-We use cookies.}</p></div><main><h1>{+Tea}</h1><section><h2>{+Green}</h2><p>{+Leaves are steamed.}</p></section><section><h2>{+Black}</h2><p>{+Leaves wither first.}</p></section></main>",
    "<nav>{-Home}</nav><article><ol><li>{+Heat the oven.}</li><li>{+Mix it all.}<ul><li>{+Flour first}</li></ul></li></ol></article><section class='related'><ul><li><a href=q>{-More recipes}</a></li></ul></section>",
    "<article><h1>{+Question}</h1><p>{+How far is it?}</p><h3>{+Answer}</h3><p>{+Four miles.}</p><form><label>{-Your mail}</label></form></article><aside class='sidebar'><p>{-Top ten}</p></aside>",
    "<div class='banner'>{-Sale today}</div><div class='post'><h1>{+Notes}</h1><p>{+" + LONG + "}</p><ul><li>{+First note}</li></ul></div><div class='footer'><p>{-All rights reserved}</p></div>",
    "<main><article><p>{+Said <i>aloud</i> and often.}</p><blockquote><p>{+We were wrong.}</p></blockquote><p>{+So it went.}</p></article></main><div class='newsletter'><form><p>{-Get our mail}</p></form></div>",
    "<article><h1>{+Maps}</h1><object data=m><p>{+A map of the coast.}</p><p>{+The coast is long.}</p></article><footer>{-About}</footer>",
    "<nav><a href=1>{-One}</a></nav><div class='story'><h1>{+Night}</h1><p>{+" + LONG + "}</p><p>{+They slept.}</p></div><div class='social'><a href=2>{-Follow us}</a></div><footer>{-Contact}</footer>",
    "<ul class='breadcrumb'><li>{-Home}</li><li>{-Sport}</li></ul><article><h1>{+Final}</h1><p>{+Two goals late.}</p></article><div class='comments'><ol><li>{-What a game}</li><li>{-Lucky}</li></ol></div>",
    "<article><h1>{+Long}</h1><div><p>{+" + LONG + "}</p><div><p>{+It rained.}</p></div></div></article><aside><ul><li>{-Popular}</li></ul></aside><footer><p>{-Press}</p></footer>",
    "<header><p>{-Site}</p></header><nav><ul><li>{-A}</li><li>{-B}</li></ul></nav><article><h4>{+Small}</h4><p>{+Very short.}</p><address>{+4 Mill Lane}</address></article>",
    "<div class='login'><form><label>{-Name}</label></form></div><main><table><tbody><tr><td>{+1912}</td><td>{+Founded}</td></tr></tbody></table><p>{+" + LONG + "}</p></main><footer>{-Jobs}</footer>",
    "<article><h1>{+Choice}</h1><p>{+Pick one of these now.}</p><p><select><option>{-Red}</select>{+That was it.}</p></article><div class='popup'><p>{-Join us}</p></div>",
    "<nav>{-Go}</nav><main><div><h1>{+Plain}</h1><div>{+" + LONG + "}</div><div>{+And then home.}</div></div></main><div class='share'><ul><li>{-Send}</li></ul></div>",
]
MARKED = re.compile(r"\{([+-])((?:[^{}])*)\}")


@pytest.fixture(scope="module")
def model():
    return H.train([H.blocks(PAGE.format(n=i)) for i in range(40)])


def test_pages_labelled_by_hand(model):
    right = found_n = wanted_n = 0
    wrong = []
    for page in HAND:
        wanted = {re.sub("<.*?>", "", text): sign == "+" for sign, text in MARKED.findall(page)}
        found = H.blocks("<html><body>" + MARKED.sub(r"\2", page) + "</body></html>")
        assert {b.text for b in found} == set(wanted), page
        marks = model.label([H.features(found)])[0]
        right += sum(m and wanted[b.text] for b, m in zip(found, marks))
        found_n += int(np.sum(marks))
        wanted_n += sum(wanted[b.text] for b in found)
        wrong += [(b.path, b.text, bool(m)) for b, m in zip(found, marks) if m != wanted[b.text]]
    assert right >= 0.95 * found_n and right >= 0.95 * wanted_n, wrong


def test_marked_inline_parts_leave_the_text_around_whole():
    found = H.blocks("<p>One. <button>Share <b>it</b></button> two <span class='ad'>Buy</span>three<select><option>A<option>B</select>.</p>")
    assert [b.text for b in found] == ["Share it", "Buy", "A B", "One. two three."]
    assert [bool(H.label_of(b.node, False)) for b in found] == [False, False, False, True]
    assert [b.text for b in H.blocks("a<button>b<div>c</div>d</button>e")] == ["a", "b", "c", "d", "e"]
    assert [b.text for b in H.blocks("<span class='readmore'>a</span> <abbr>b</abbr>")] == ["a b"]
    assert H.blocks("<div><abbr>b</abbr></div>")[0].path == ("div",)


def test_elements_without_an_end():
    texts = lambda page: [b.text for b in H.blocks(page)]
    assert texts("<p>a</p><object><p>b</p><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a<select><option>x</p><p>b</p>") == ["a", "x", "b"]
    assert texts("<p>a</p><textarea><p>b</p><iframe><svg><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a</p><script>var b;<p>c</p>") == ["a"] and texts("<p>a<script>x</script> b</p>") == ["a b"]
    assert texts("<dl><dt>a<dd>b<dt>c</dl><table><tr><td>d<td>e</table>") == ["a", "b", "c", "d", "e"]
    assert H.blocks("<dl><dt>a<dd>b</dl>")[1].path == ("dl", "dd")


@pytest.mark.parametrize("piece", ["<div>", "<div>x", "<object>", "<textarea>x", "<select>", "<b>", "<p><span class=ad>x"])
def test_time_grows_with_length_only(piece):
    start = time.perf_counter()
    found = H.blocks(piece * 20_000 + "end")
    H.features(found)
    assert found[-1].text.endswith("end") and time.perf_counter() - start < 5
