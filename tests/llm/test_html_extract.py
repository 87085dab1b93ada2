from hourwise.llm import html_extract as he

MODEL = {"tag": {"p": 0.0, "h1": 0.0, "b": 0.0, "br": 0.0, "nav": -3.25, "a": -3.0, "li": -3.0, "ul": -3.25, "div": -1.0}, "out": frozenset({"div.teaser"})}
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head><body><script>var t="</p>";</script>
<header>Site head</header><nav><ul><li><a href="/a">menu one</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title  of &amp; it</h1><p><b>First para.<br><p>Second&nbsp;para&#33; a &lt; b &eacute;<p>Third
 one <a href=x>link</a> end.</p><div class="ad">Buy <p>now</p></div><form><p>Mail</p><input></form><ul><li>item</li></ul><p>Last.</p></article>
<section class="comments"><p>I disagree with it all, a long reader comment.</p></section><aside>Side</aside><footer>&copy; x</footer></body></html>"""


def test_page():
    assert he.extract(PAGE, MODEL) == "\n".join(["Title of & it", "First para.", "Second para! a < b é", "Third one link end.", "item", "Last."])


def test_page_without_article_element():
    body = "".join(f"<p>Paragraph {i} has some words in it.</p>" for i in range(5))
    page = f"<body><nav><ul><li><a>Home</a><li><a>News</a></ul></nav><div class=teaser>Read also</div><div class=post>{body}</div><div id=footer>Imprint, contact</div>"
    assert he.extract(page, MODEL) == "\n".join(f"Paragraph {i} has some words in it." for i in range(5))


def test_headers_of_articles_and_of_sites():
    page = "<header><h1>Site</h1></header><main><article><header class='entry-header'><h2>Title</h2></header><p>Text a</p><footer>tags</footer>"
    page += "<div class='header'>x</div><div class='post-header'>y</div></article><div class='comments'><article class='comment'>no</article></div></main>"
    assert he.extract(page, MODEL) == "Title\nText a\ny"


def test_broken_and_empty_pages():
    assert he.extract(None, MODEL) == he.extract("", MODEL) == he.extract("<p></p><!-- x", MODEL) == he.extract("<nav>a b c</nav>", MODEL) == ""
    assert he.extract("plain words only", MODEL) == "plain words only"
    assert he.extract("<article>a <b>b <i>c</article> d", MODEL) == "a b c"
    assert he.extract("<article>1 < 2 and 3 > 2 <p>x", MODEL) == "1 < 2 and 3 > 2\nx"
    assert he.extract("<article>a<script>if (a<b) '</p>'", MODEL) == "a"
    assert he.extract("<article>" + "<div>" * 3000 + "deep" + "<p title='a" * 3000, MODEL).startswith("deep")
    words = " ".join(f"w{i}" for i in range(300_000))
    assert he.extract(f"<article><p>{words}</p></article>", MODEL) == words


def test_elements_without_an_end():
    assert he.extract("<html><head><title>T</title><body><article><p>a b</p></article>", MODEL) == "a b"
    assert he.extract("<html><head><meta charset=x><title>T<article><p>a b</p></article>", MODEL) == "a b"
    for empty in ("<svg class=i/>", "<svg/>", "<math/>", "<svg><path d=x>", "<video src=x>", "<canvas>", "<iframe src=x/>", "<noscript>", "<object>"):
        assert he.extract(f"<article>a {empty} b<p>c</p></article>", MODEL) == "a b\nc"
        assert he.extract(f"<article>a {empty} b<p>c</p><svg><text>no</text></svg></article>", MODEL) == "a b\nc"
    assert he.extract("<head><script src=x><body><article>a</article>", MODEL) == "a"
    assert he.extract("<article>a<svg><svg><text>x</text></svg><text>y</text></svg> <select><option>z</select>b<script>'<p>c'</script ></article>", MODEL) == "a b"
    assert he.extract("<article>a" + "<svg>" * 20_000 + "<iframe>" * 20_000 + "<script>" * 20_000, MODEL) == "a"


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding=t>no</annotation></semantics></math>"
    assert he.extract(f"<article><p>Let {formula} be.</p></article>", MODEL) == "Let x=1 be."
    assert he.extract(f"<nav>n</nav><p>Let {formula} be.</p>", MODEL) == "Let x=1 be."


def test_names_on_what_holds_the_article():
    text = "<p>" + "some words of the text " * 20 + "</p>"
    want = " ".join("some words of the text".split() * 20)
    side = "<nav>a b c</nav><div class=sidebar>d e f</div><div class=comments><article class=comment>no</article></div>"
    for name in ("has-sidebar", "no-sidebar", "comments-open", "nav-open", "with-banner", "teaser"):
        for page in (f"<html class={name}><body class='{name}'>{side}<article>{text}</article>", f"<body><div class={name}><article>{text}</article>{side}</div>",
                     f"<body>{side}<article class={name}>{text}</article>", f"<body><main><div id={name}>{text}</div></main>{side}",
                     f"<body><form><div class={name}>{side}<div>{text}</div>{side}</div></form>"):
            assert he.extract(page, MODEL) == want, page
    assert he.extract(f"<body><form>{side}<article>{text}<form>Mail</form></article></form>", MODEL) == want


def test_long_discussion_stays_out():
    text = "<p>" + "word " * 40 + "</p>"
    for name in ("comments", "reply-list"):
        page = f"<body><main><article>{text}</article><section class={name}>" + "<p>I disagree with all of it.</p>" * 100 + "</section></main>"
        assert he.extract(page, MODEL) == " ".join(["word"] * 40)
        assert he.extract(f"<form>{page}</form>", MODEL) == " ".join(["word"] * 40)
    assert he.extract("<nav>a b c</nav><aside>d</aside>", MODEL) == ""


def test_articles_that_are_not_the_text():
    for name in ("related", "comment"):
        page = "<div id=post><p>" + "word " * 40 + "</p></div>" + f"<article class={name}>not this</article>" * 3
        assert he.extract(page, MODEL) == " ".join(["word"] * 40)


def test_learned_from_labelled_pages(spark):
    rows = [(i, f"u{i}", f"<body><div class=promo2>buy {i} now</div><article><p>text of page {i}</p></article>") for i in range(20)]
    rows += [(50, None, None), (51, "u", ""), (52, "u", "<body><div class=promo2>buy it</div><p>some text here</p>"), (0, "u0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = he.learn(pages)
    assert "div.promo2" in model["out"] and model["tag"]["p"] == 0 and model["tag"]["div"] == he.TAG
    got = sorted(((x.page_id, x.url, x.text, x.n_chars) for x in he.extracted(pages).collect()), key=repr)
    text = {r[0]: f"text of page {r[0]}" for r in rows[:20]} | {50: "", 51: "", 52: "some text here"}
    assert got == sorted(((i, u, text[i], len(text[i])) for i, u, _ in rows), key=repr)
    assert he.extracted(pages.limit(0)).collect() == []


def test_rare_labels_teach(spark):
    plain = [(i, f"<body><p>no label {i}</p><article>a</article><article>b</article>") for i in range(3000)]
    label = [(5000 + i, f"<body><div class=promo2>buy {i} now</div><main><article><p>text of page {i}</p></article></main>"
                        "<div class=comments><article>c</article></div>") for i in range(20)]
    pages = spark.createDataFrame(plain + label, "page_id long, html string")
    model = he.learn(pages, train_pages=20)
    assert "div.promo2" in model["out"] and model["tag"]["p"] == 0
    # a page with many copies has its share of a sample of a fixed size; repeated rows count once
    copies = [(9000 + i, label[0][1]) for i in range(300)] + [label[1]] * 300
    many = pages.union(spark.createDataFrame(copies, "page_id long, html string"))
    got = [x.html for x in he.sample(many, 100).collect()]
    assert len(got) == 100 and 60 < got.count(label[0][1]) and got.count(label[1][1]) <= 1
    assert he.sample(many, 1000).count() == 320


def test_all_supported_keys_are_kept(spark):
    page = "".join(f"<div class=c{i}>a b c d</div>" for i in range(5000)) + "<article>text</article>"
    pages = spark.createDataFrame([(i, page) for i in range(5)], "page_id long, html string")
    assert len(he.learn(pages)["out"]) == 5000


def words(w, n):
    return " ".join([w] * n)


def test_named_elements_beside_content_stay_out_at_any_size():
    for name in ("comments", "related", "promo", "reply-list"):
        for n in (60, 900, 20_000):
            story = f"<p>{words('a', 40)}</p>"
            for page in (f"<body><article>{story}</article><div class={name}>{words('x', n)}</div>", f"<article>{story}<div class={name}>{words('x', n)}</div></article>",
                         f"<body><div id=post>{story}</div><div class={name}><p>{words('x', n)}</p></div>", f"<div class={name}>{words('x', n)}</div><main>{story}</main>"):
                assert he.extract(page, MODEL) == words("a", 40), page[:80]
        assert he.extract(f"<body><nav>n</nav><div class={name}><p>{words('x', 30)}</p></div>", MODEL) == words("x", 30)


def test_attribute_values_with_signs():
    for value in ("a<b", "a>b", "<b>bold</b>", "x</p>y", "a'b"):
        assert he.extract(f'<article><p data-x="{value}">hello</p> <img alt="{value}">there</article>', MODEL) == "hello\nthere"
    assert he.extract("<article><p title='a\"b<c'>hello<p don't>it's <b x=\"1>2\">so</b></article>", MODEL) == "hello\nit's so"
    assert he.extract('<article><p title="open>hello</p></article>', MODEL) == "hello"


def test_no_article_and_no_part_of_a_story_is_lost():
    two = f"<article>{words('a', 40)}</article><div>{words('x', 60)}</div><article>{words('b', 30)}</article>"
    assert he.extract(f"<body>{two}</body>", MODEL) == words("a", 40) + "\n" + words("b", 30)
    for n in (60, 5000):
        story = f"<p>{words('a', 40)}</p><div class=ad>{words('x', n)}</div><p>{words('b', 30)}</p>"
        for page in (f"<article>{story}</article>", f"<body><div id=post>{story}</div>"):
            assert he.extract(page, MODEL) == words("a", 40) + "\n" + words("b", 30)


def test_names_inside_an_article():
    inner = "<p class=alert>one</p><p class='comment'>two</p><section id=related-work><h2 id=comments>three</h2>four</section><ul><li class=notice>five</li></ul>"
    assert he.extract(f"<article><p>zero</p>{inner}</article>", MODEL) == "\n".join("zero one two three four five".split())
    chrome = "<div class=alert>x</div><section id=related-posts>y</section><div id=comments>z</div><section class=related-work>v</section>"
    assert he.extract(f"<article><p>zero</p>{chrome}</article>", MODEL) == "zero"


def test_work_is_linear_in_depth():
    import time

    def took(n):
        page = "<article>" + "<div class=c>" * n + "deep" + "</span>" * n + "</i></b>" * n
        t = time.process_time()
        assert he.extract(page, MODEL) == "deep"
        he.count_page(page)
        return time.process_time() - t
    took(1000)
    assert took(32_000) < 12 * max(0.2, took(8_000))


def best_region(scores):
    """All regions tried; of equal sums the one that ends first, and then the shortest."""
    best = (0.0, 0, 0)
    for j in range(1, len(scores) + 1):
        total = 0.0
        for i in range(j - 1, -1, -1):
            total += scores[i]
            if total > best[0] + 1e-9:
                best = (total, i, j)
    return best


def test_region_against_brute_force():
    """Pages without article elements, of paragraphs, lists and adverts: the region is the best of all."""
    import random
    rng = random.Random(8)
    for _ in range(200):
        parts, scores = [], []
        for k in range(rng.randrange(1, 14)):
            kind, n = rng.choice(["p", "li", "ad"]) if k else "p", rng.randrange(1, 8)
            if kind == "ad":
                parts.append(f"<section class=ad>{words('x', n)}</section>")
                scores += [(-0.5, None), (he.TAG, None), (-0.5, None)]
            else:
                parts.append(f"<{kind}>{words(f'w{k}', n)}</{kind}>")
                cost = MODEL["tag"][kind]
                scores += [(cost, None), (float(n), words(f"w{k}", n)), (cost, None)]
        total, first, last = best_region([s for s, _ in scores])
        want = "\n".join(t for _, t in scores[first:last] if t) if total else ""
        assert he.extract("".join(parts), MODEL) == want


def test_extra_columns_repeats_and_empty_tables(spark):
    rows = [(i, "u", f"<body><div class=promo2>buy now</div><article><p>text {i}</p></article>") for i in range(8)] * 2
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "'q' as text", "7L as n_chars", "1 as h")
    got = he.extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((x.page_id, x.text, x.n_chars) for x in got.collect()) == sorted((i, f"text {i}", 6) for i, _, _ in rows)
    assert he.extracted(pages.limit(0)).count() == 0
