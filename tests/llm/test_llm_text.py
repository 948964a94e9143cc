"""Per-text functions against plain Python, on random and awkward texts."""

import base64
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import bpe, html, leaks, licences, pii, quality, simhash, words
from tests.llm import brute

TEXT = st.text(alphabet="ab AB\t\n\x0b\x0cé漢#|1@.+-()  \x1c\xa0", max_size=120)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_counts(texts):
    got = quality.text_counts([t.encode() for t in texts])
    assert [tuple(int(got[k][i]) for k in quality.COUNTS) for i in range(len(texts))] == [brute.quality(t) for t in texts]


def test_counts_across_chunks(monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 60))) for _ in range(80)]
    monkeypatch.setattr(words, "CHUNK", 97)
    monkeypatch.setattr(words.chunks, "__defaults__", (97,))
    got = quality.text_counts([t.encode() for t in texts])
    assert [int(x) for x in got["n_repeat_words"]] == [brute.quality(t)[4] for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0123456789.@+-() ab_%\n#", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.pii(text)


def test_base_spans_long_runs():
    assert pii.base_spans("1" * 200_000) == []
    assert pii.base_spans("a" * 100_000 + "@" + "b" * 1000) == []
    assert len(pii.base_spans("x@y.zz " * 5000)) == 5000


def test_islands_are_whole_tokens_and_long_words_are_cheap():
    import time

    found = lambda t: [m[0] for m in pii._ISLAND.finditer(t)]
    assert found("ab c1 d2  e f3\ng4 @x") == ["c1 d2", "f3", "g4 @x"]
    start = time.perf_counter()
    assert found("a" * 300_000) == [] and found("a" * 300_000 + "1") != []
    assert time.perf_counter() - start < 5


def test_field_splits_what_the_patterns_cannot():
    cards, phones = ["4539578763621486", "4716461583322103", "4024007103939509"], ["+1 (443) 555-5793", "+1 (372) 555-7739"]
    texts = [*cards, *phones, "10.20.30.40", "me.1@mail.example.com", "1234567890123456", "7", "1.", "2024", "99 12"]
    samples = {}
    for t in texts:
        for made, gold in [(pii.Island(t), pii._gold(pii.Island(t), pii.base_spans(t)))]:
            samples.setdefault(made.key(), [made, gold, 0])[2] += 5
    field = pii.Field().train([tuple(x) for x in samples.values()])
    two = f"x {cards[0]} {cards[1]} y"
    assert pii.base_spans(two) == []
    found = {s[:3] for s in pii.all_spans(two, field, {})}
    assert found <= {("card", 2, 18), ("card", 19, 35)} and found
    assert pii.all_spans("call 1234567890123456 now", field, {}) == []
    base = f"{cards[0]}, {phones[0]}"
    assert {s[:3] for s in pii.all_spans(base, field, {}) if s[3]} == set(brute.pii(base))
    assert pii.masked(base, pii.all_spans(base, field, {})) == "[CARD], [PHONE]"


def test_untrained_field_adds_nothing():
    assert pii.all_spans("4539578763621486 4716461583322103", pii.Field().train([]), {}) == []


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(TEXT, st.text(max_size=60), st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60), st.sampled_from(["a" * 300, "ab" * 99, "the" * 40, "-" * 129, "é" * 70])))
def test_encode(vocabulary, tiktoken_encoding, text):
    import numpy as np
    import regex

    pieces = bpe.Cutter(vocabulary.pattern)(text)
    assert pieces == regex.findall(vocabulary.pattern, text)
    ids = np.frombuffer(b"".join(vocabulary.encode([p])[p] for p in pieces), dtype=np.int32)
    assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
    assert vocabulary.decode(ids, np.array([0, len(ids), len(ids)])) == [b"", text.encode(), b""]
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([len(vocabulary.sizes)]), np.array([1]))


def test_long_islands_are_decoded_whole():
    r = random.Random(8)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    some = lambda: r.choice(["4539578763621486", "4716461583322103", f"+1 ({number(3)}) {number(3)}-{number(4)}", f"a{number(2)}@x.example.com",
                             f"10.{r.randint(0, 255)}.3.{r.randint(0, 400)}", number(6), f"({number(2)}#", f"+{number(4)}"])
    samples = {}
    for _ in range(60):
        made = pii.Island(r.choice([" ", "# "]).join(some() for _ in range(r.randint(1, 4))))
        gold = pii._gold(made, pii.base_spans(made.text))
        if gold is not None:
            samples.setdefault((made.key(), tuple(gold)), [made, gold, 0])[2] += 1
    field = pii.Field().train([tuple(x) for x in samples.values()])
    text = " ".join(some() for _ in range(400))
    whole = pii.Island(text)
    want = [(whole.starts[i], whole.ends[j - 1], k, p) for i, j, k, p in field.entities(whole)]
    assert len(whole.other) > 3 * pii.CHUNK_PIECES and len(text) > 4000 and list(field.long_entities(text)) == want
    noisy = lambda at: "1 " * (at // 2) + "4539578763621486###4716461583322103## " + "1 " * 400
    spans = {at: {(k, a - at, b - at) for k, a, b, _ in pii.all_spans(noisy(at), field, {})} for at in range(770, 806, 2)}
    assert len(set(map(frozenset, spans.values()))) == 1


def test_no_island_with_a_candidate_is_skipped():
    """The quick look at an island is exact: digits far apart, other scripts' digits and letters, signs between."""
    r = random.Random(6)
    for _ in range(4000):
        text = "".join(r.choice(["1", "23", "a", "é", "²", "Ⅷ", "٣", "漢", ".", "-", "#", "#######", " ", "@", "_"]) for _ in range(r.randint(1, 14))).strip()
        if pii.Island(text).candidates:
            assert pii._may_hold(text), text
    assert pii._may_hold("1" + "#" * 40 + "2" + "*" * 9 + "34") and not pii._may_hold("12ab34cd56") and not pii._may_hold("1.2.3")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- <p>no</p> --><div class="ad">Buy now</div><div id="sidebar"><p>Side words of some length here</p></div>
<article><header><h1>Big &amp; small</h1></header><p>First <b>bold</b>part
  of text &lt;here&gt;.<br>Next line<p>Second paragraph, quite long, with <a href="x">a link</a> in it.
<ul><li>one<li>two</ul><form><input><button>Send</button></form>
<div class="comments"><p>Reader says something long enough to look like text, no doubt about it.</p></div></article>
<footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == ("Big & small First boldpart of text <here>. Next line Second paragraph, quite long, "
                                    "with a link in it. one two")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just words  and\nmore", "just words and more"), ("<p>cut off in a ta", "cut off in a ta"),
    ("<p>cut off in <a href='x", "cut off in"), ("<p>a<!-- never ends <p>b", "a"), ("</p></div>x", "x"),
    ("<article><p>kept &am", "kept &am"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("\0<p>\0a", "a"),
])
def test_main_text_of_odd_pages(page, text):
    assert html.main_text(page) == text


def test_main_text_without_article_takes_the_dense_part():
    para = "".join(f"<p>{'word ' * 40}</p>" for _ in range(6))
    links = "".join(f"<li><a href='/{i}'>Some link {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div id='main-part'>{para}</div><div><a href='/'>x</a> tiny</div></body>"
    assert html.main_text(page) == " ".join(["word"] * 240)


def test_main_text_is_linear_in_deep_pages():
    assert html.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"


def test_deep_nesting_of_many_kinds():
    r = random.Random(2)
    soup = "".join(r.choice(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<b>", "</b>", "<td>", "<table>", "x y ", "<article>", "</div>"])
                   for _ in range(5000))
    assert re.sub(r"\s", "", html.main_text(soup)).strip("xy") == ""


def test_index_finds_all_within_the_radius():
    r = random.Random(1)
    vocab = [f"w{i}x" for i in range(300)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([12, 30])))) for i in range(20)] + [(20, "three short words"), (21, ""), (22, None)]
    index = leaks.Index(items)
    docs = []
    for d in range(60):
        w = r.choices(vocab, k=r.randint(0, 80))
        if d % 2:
            x = items[d % 20][1].split()
            for _ in range(r.randint(0, 2)):
                x[r.randrange(len(x))] = "other"
            at = r.randint(0, len(w))
            w[at:at] = x
        docs.append((d, " ".join(w).upper() if d % 3 else " ".join(w) + "!"))
    docs += [(60, "THREE, short words."), (61, ""), (62, None), (63, items[0][1])]
    got = {(docs[t][0], i, round(s, 9)) for t, i, _, _, _, s in index.search([t for _, t in docs])}
    assert got == brute.leaks(docs, items)


def test_a_very_long_text_against_many_items_of_one_length():
    """200,000 words that share a shingle with each of 4,096 items at 100 places: memory stays small, leaks are found."""
    import tracemalloc

    common = "one two three four five"
    items = [(i if i else None, f"{common} item{i} has seven words more a{i} b{i} c{i}") for i in range(4096)]
    index = leaks.Index(items)
    r = random.Random(3)
    words = [f"w{r.randrange(5000)}" for _ in range(200_000)]
    for at in range(0, 200_000, 2000):
        words[at:at + 5] = common.split()
    words[100_003:100_003] = items[77][1].split()
    words[50_003:50_003] = items[0][1].split()
    tracemalloc.start()
    got = index.search([" ".join(words)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(f[1], f[5]) for f in got] == [(77, 1.0), (None, 1.0)]
    assert peak < 500 << 20


def test_hamming_blocks_guarantee():
    import numpy as np

    r = np.random.default_rng(0)
    index = leaks.Index([(i, " ".join(f"{i}a{k}" for k in range(9))) for i in range(50)])
    group = index.lengths[9]
    near = group["fp"][r.integers(0, 50, 400)].copy()
    for x in range(400):
        for b in r.choice(64, r.integers(0, 26), replace=False):
            near[x] ^= np.uint64(1 << int(b))
    want = {(w, i) for w in range(400) for i in range(50) if int(near[w] ^ group["fp"][i]).bit_count() <= index.radius}
    assert {(w, i) for w, i, _ in index.lookup(group, near)} == want


def test_licence_weights_have_length_one():
    known, unknown = licences.weights()
    for t in range(len(licences.TEMPLATES)):
        assert sum(v[t] ** 2 for _, v in known.values()) == pytest.approx(1)
    assert unknown >= max(w for w, _ in known.values())


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'class="overflow-hidden"', 'class="entry-content share-enabled"', 'class="content no-sidebar"',
    'id="related-work"', 'data-class="ad"', 'class="share"', 'role="search"', 'hidden="until-found"', "class=story data-x='display:none'",
])
def test_a_name_alone_cuts_no_main_text(attributes):
    paragraphs = "".join(f"<p>{f'word{i} ' * 30}</p>" for i in range(4))
    want = " ".join(f"word{i}" for i in range(4) for _ in range(30))
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(9)) + "</ul>"
    assert html.main_text(f"<body><nav>{links}</nav><div {attributes}>{paragraphs}</div></body>") == want
    assert html.main_text(f"<body><nav>{links}</nav><article><div {attributes}>{paragraphs}</div></article></body>") == want


@pytest.mark.parametrize("element", [
    "<div hidden>x y z</div>", "<div style='color:red; display : none'>x y z</div>", "<div class='ad'>x y z</div>",
    "<div class='post-share'><a href='/'>x y z</a></div>", "<aside>x y z</aside>", "<div class='navMenu'>x y z</div>",
])
def test_hidden_link_heavy_and_small_named_elements_go(element):
    body = f"<p>{'word ' * 30}</p>"
    assert html.main_text(f"<body><a href='/'>l</a><article>{body}{element}{body}</article></body>") == " ".join(["word"] * 60)


@pytest.mark.parametrize("attributes", [
    "class='comment-list'", "class='comment-thread'", "class='sidebar-left'", "class='ad-slot-top'", "class='cookie-bar'", "id='site-footer'",
    "id='comments'", "class='commentList'", "id='main-nav'", "class='related-links'", "class='widget_area-2'", "role='complementary'",
])
@pytest.mark.parametrize("longer", [1, 12])
def test_boilerplate_by_whole_names_goes_with_all_its_text(attributes, longer):
    """With and without an article, also where it has more text than the article itself, and inside the article."""
    links = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(9)) + "</ul></nav>"
    paragraphs = "".join(f"<p>{f'word{i} ' * 40}</p>" for i in range(4))
    want = " ".join(f"word{i}" for i in range(4) for _ in range(40))
    extra = f"<div {attributes}>" + "".join(f"<p>{f'other{i} ' * 30}</p>" for i in range(4 * longer)) + "</div>"
    for page in (f"<article>{paragraphs}</article>{extra}", f"<div>{paragraphs}</div>{extra}", f"{extra}<div>{paragraphs}</div>",
                 f"<article>{paragraphs}{extra}</article>", f"<article>{extra}{paragraphs}</article>"):
        got = html.main_text(f"<body>{links}{page}</body>")
        assert "other" not in got and got.split() == want.split()


def test_comments_marked_up_as_articles_go():
    paragraphs = "".join(f"<p>{'word ' * 40}</p>" for _ in range(4))
    said = "".join(f"<article class='comment'><p>{'reply ' * 50}</p></article>" for _ in range(9))
    for page in (f"<main>{paragraphs}<section id='comments'>{said}</section></main>", f"<article>{paragraphs}</article><section id='comments'>{said}</section>",
                 f"<div>{paragraphs}</div><ol class='comment-list'><li><article>{'reply ' * 300}</article></li></ol>"):
        assert html.main_text(f"<body>{page}</body>") == " ".join(["word"] * 160)


def test_a_form_around_the_page_is_no_form():
    """What is in it is judged by its own: the article stays, the sidebar in it goes."""
    paragraphs = "".join(f"<p>{'word ' * 40}</p>" for _ in range(4))
    side = "<div id='sidebar'>" + "".join(f"<p>{'side ' * 9}</p>" for _ in range(3)) + "</div>"
    assert html.main_text(f"<body><form id='aspnetForm'>{side}<div>{paragraphs}</div></form></body>") == " ".join(["word"] * 160)


def plain_counts(node):
    """Characters, tags, link characters and link tags below an element, straight from the definition."""
    chars = tags = link_chars = link_tags = 0
    for x in node.children:
        if isinstance(x, str):
            n = len(re.sub(r"\s", "", x))
            chars, link_chars = chars + n, link_chars + n * (node.tag == "a")
        else:
            c, t, lc, lt = plain_counts(x)
            chars, tags, link_tags = chars + c, tags + t + 1, link_tags + lt + (x.tag == "a")
            link_chars += c if node.tag == "a" else lc
    return chars, tags, link_chars, link_tags


def plain_density(node, share):
    import math

    c, t, lc, lt = plain_counts(node)
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + lc * 0 + share * c + math.e)
    return c / max(1, t) * math.log(max(math.e, c / max(1, lc) * max(1, t) / max(1, lt))) / math.log(base) if base > 1.01 else 0.0


def test_densities_equal_their_definition_on_random_pages():
    """Composite densities and density sums of every element of small random trees, recomputed one by one."""
    r = random.Random(11)

    def some(depth):
        out = []
        for _ in range(r.randint(0, 4)):
            tag = r.choice(["div", "p", "a", "b", "section", "li", "span"])
            inner = some(depth - 1) if depth and tag != "p" else "".join(r.choice("ab c") for _ in range(r.randint(0, 60)))
            out.append(f"<{tag}>{inner}</{tag}>")
        return "".join(out)

    for _ in range(60):
        root, nodes = html.parse(f"<body>{some(4)}</body>")
        html._count(nodes)
        body = next(x for x in nodes if x.tag == "body")
        share = html._measure(nodes, body)
        c, _, lc, _ = plain_counts(body)
        assert share == pytest.approx(lc / c if c else 0.0)
        for x in nodes:
            assert (x.chars, x.tags, x.link_chars, x.link_tags) == plain_counts(x)
            assert x.density == pytest.approx(plain_density(x, share))
            assert x.sum == pytest.approx(sum(plain_density(y, share) for y in x.children if not isinstance(y, str)))


def test_threshold_decides_every_side_branch():
    links = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(9)) + "</ul></nav>"
    cards = "".join(f"<article><a href='/{i}'>Teaser {i} <i>of</i> <i>a</i> <i>story</i></a></article>" for i in range(3))
    main = "<div class='story'>" + "".join(f"<p>{'word ' * 40}</p>" for _ in range(6)) + "</div>"
    page = f"<body>{links}<div>{cards}</div>{main}{cards}<section>{'side ' * 60}</section><a href='/'>more</a></body>"
    assert html.main_text(page) == " ".join(["word"] * 240 + ["side"] * 60)
    runs = f"<body>{links}{'early ' * 60}<b>bold</b> {'x ' * 60}{main}tiny<br>{cards}</body>"
    got = html.main_text(runs).split()
    assert got[:61] == ["early"] * 60 + ["bold"] and got[-1] == "word" and "Teaser" not in got
