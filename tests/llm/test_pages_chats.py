"""HTML extraction, URL filters and chat formatting."""

import html as H
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from helpers import rows_of, sha

from eventfeat.llm import chat, htmltext, htmltree, urls


@pytest.fixture(scope="module")
def model():
    return htmltext.train(pages=250, steps=100)


def test_messages_equal_enumeration():
    """Marginals and pair marginals of sum-product against the sum over all labellings."""
    rng = np.random.default_rng(1)
    tree = htmltree.parse("<body><div><p>a</p><ul><li>b</li></ul></div><nav>c</nav></body>")
    f = htmltext.Forest([tree], grow=True)
    w, pairs = rng.normal(size=len(f.index)), rng.normal(size=(len(htmltext._GROUPS),) * 2 + (2, 2))
    p, both = f.messages(w, pairs)
    unary = np.bincount(f.node, w[f.feat], len(f.parent))
    total, marg, pair = 0.0, np.zeros(len(p)), np.zeros((len(p), 2, 2))
    for y in itertools.product((0, 1), repeat=len(p)):
        y = np.array(y)
        s = np.exp((unary * y).sum() + sum(pairs[f.group[f.parent[n]], f.group[n], y[f.parent[n]], y[n]] for n in range(1, len(p))))
        total += s
        marg += s * y
        for n in range(1, len(p)):
            pair[n, y[f.parent[n]], y[n]] += s
    assert np.allclose(p, marg / total) and np.allclose(both[1:], pair[1:] / total)


def test_held_out_accuracy(model):
    rng = random.Random(1234)
    trees = [htmltree.parse(htmltree.labelled_page(rng), labelled=True) for _ in range(200)]
    right = wrong = 0
    for t, got in zip(trees, htmltext.extract(trees, model)):
        a = [x for x, tag, y in zip(t.text, t.tag, t.label) if tag == "#" and y == 1]
        b = got.split("\n") if got else []
        right += len(set(a) & set(b))
        wrong += len(set(a) ^ set(b))
    assert right / (right + wrong) > 0.97


def test_corpus_pages(spark, small_dir, model):
    """The corpus' own layout: the blocks of its article, nothing else."""
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want[r.page_id] = "\n".join(x for x in blocks if x)
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.extract_text(pages, model=model).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


ARTICLE = "<article><p>The article, as it stands.</p></article>"


@pytest.mark.parametrize("before", [
    "<script>for(var i=0;i<n;i++){f(i)}</script>", "<script>if (i<n) s = 'it';</SCRIPT >", "<style>a<b {content: \"'\"}</style>",
    "<script>x = '<script'; y = a<b && \"</p>\"</script>", "<head><title>t</title>", "<head><script>w('<head>')</script></head><body>",
    "<head><title>a<b</title><meta charset=utf-8><body>", "<div><button>Menu</div>", "<button>", "<select><option>", "<svg>", "<template>",
    "<button><div>Label</div></button>", "<template><p>no</p><template>no</template>no</template>", "<div title=don't></div>",
    "<select><option>no</select><button>no</button>", "<textarea>no</p></textarea>", "<title>", "<noscript>", "<object>"])
def test_nothing_before_an_article_hides_it(before):
    tree = htmltree.parse(f"<html>{before}{ARTICLE}<p>Behind it.</p>")
    text = [x for x in tree.text if x]
    assert text[-2:] == ["The article, as it stands.", "Behind it."] and "no" not in " ".join(text[:-2]).split()


def test_parts_of_an_article_that_are_text():
    tree = htmltree.parse("<article><p>Let <math><mi>x</mi></math> be <svg><text>y</text></svg>, "
                          "<object>z</object><noscript>, w</noscript><button>no</button>.</p></article>")
    assert [x for x in tree.text if x] == ["Let x be y, z, w."]


def test_all_names_of_an_element_are_kept():
    classes = " ".join(f"{x}-{y}" for x in "flex grid pad gap row".split() for y in "sm md lg xl".split())
    tree = htmltree.parse(f'<div class="{classes} comments" id="sidebar">x</div>')
    assert {"flex", "xl", "comments", "sidebar"} <= set(tree.names[1]) and len(tree.names[1]) == 11


@pytest.mark.parametrize("n", [1, 5, 19, 20])
def test_few_labelled_urls(spark, n):
    pages = spark.createDataFrame([(k, f"https://site{k}.example/a/{k}") for k in range(30)] + [(99, "https://x.example/")], "page_id long, url string")
    labels = spark.createDataFrame([(k, 0, 1) for k in range(n)], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, labels).collect()}
    alone = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages).collect()}
    assert len(got) == 31 and (n == 20 or got == alone)


def test_script_before_an_article(spark, model):
    page = f"<body><script>for(var i=0;i<n;i++){{f(i)}}</script>{ARTICLE}"
    got = htmltext.extract_text(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), model=model).first()
    assert got.text == "The article, as it stands."


def test_labels_of_real_pages_are_attributes_like_others(spark, model):
    odd = ["a", "12.5", "", None, "1", "99999999999999999999"]
    rows = [(k, "u", f"<article data-y{'' if v is None else '=' + repr(v)}><p>The article, as it stands.</p></article>") for k, v in enumerate(odd)]
    got = htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), model=model).collect()
    assert {r.text for r in got} == {"The article, as it stands."}


def test_mutated_pages_parse(model):
    """No page crashes, and every leaf's text comes from the page."""
    rng = random.Random(12)
    bits = ["<a ", '="', "='", ">", '"', "'", "<", "</", "<!--", "-->", "&#", "&amp;", "<p>", "</div>", "<script>", "</select>", "<li>", 'data-y="x"', "\x00", "<td =>"]
    trees = []
    for _ in range(2000):
        page = htmltree.labelled_page(rng)
        for _ in range(rng.randint(1, 8)):
            k = rng.randrange(len(page))
            page = page[:k] + rng.choice(bits) + page[k + rng.randint(0, 4):]
        trees.append(htmltree.parse(page))
        assert all(p < k for k, p in enumerate(trees[-1].parent))
    assert len(htmltext.extract(trees[:200], model)) == 200


@pytest.mark.parametrize("piece", ["<a ", "<a =", '<a ="', "<a =\"<b ='", "<", "<div>", "<address>", "<textarea>", "<select><div></p>", "<ul><li>", "</li>", "<!--"])
def test_hostile_pages_take_linear_time(piece):
    import time

    def seconds(n):
        page, began = piece * (n // len(piece)) + '=">"' + "</li>" * 2000, time.process_time()
        htmltree.parse(page)
        return time.process_time() - began

    seconds(50_000)
    assert seconds(800_000) < 40 * max(seconds(50_000), 0.05)  # 16 times the page


def test_very_deep_pages_extract(model):
    tree = htmltree.parse("<div>" * 20_000 + "<p>Deep words, and more of them.")
    assert len(htmltext.extract([tree], model)) == 1


def test_awkward_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p>Fish &amp; chips &lt;b&gt; caf&eacute; &#8364;5 are\n\t good   food, and cheap."),
            (5, "u", "<article><p>One<p>Two <b>bold</b>er<br>line</article></div></nav><script>if (a</b) x('</p>')</script>"), (None, "u", "<!-- <p>no</p> --><nav><a href=x>m</a></nav>"),
            (6, "u", "<article>" + "<p>Many words, of one long page.</p>" * 3000 + "</article>"), (6, "u", "<article><p>Many words.</p></article>"), (7, "u", "<a <b <c" * 50)]
    got = rows_of(htmltext.extract_text(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int"), model=model))
    by = {(r[0], r[3] > 100): r[2] for r in got}
    assert len(got) == len(rows) and by[(1, False)] == by[(2, False)] == by[(None, False)] == ""
    assert by[(4, False)] == "Fish & chips <b> café €5 are good food, and cheap."
    assert by[(5, False)] == "One\nTwo bolder line"
    assert by[(6, True)] == "\n".join(["Many words, of one long page."] * 3000)
    assert htmltext.extract_text(spark.createDataFrame([], "page_id long, url string, html string"), model=model).count() == 0


def judged(url):
    u = url or ""
    k = u.find("://")
    rest = u[k + 3:] if k >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), h + p, v) for h, p, v in urls.POLICY if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/1?x=/en/", "http://example.com", "http://example.com?x", "https://www.example.com/en/2#a/b", "https://a.www.example.com/en/",
        "https://b.example.com/en", "https://b.example.com/en/", "ftp://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://a.org/es/://z", "http://com/", "http://É.ORG/p/a.html"]


def test_listed_rules(spark):
    got = rows_of(urls.judge_urls(spark.createDataFrame([(n, u, "r") for n, u in enumerate(URLS)], "page_id long, url string, rule string")))
    assert got == sorted(((n, *judged(u)[:3], judged(u)[3] or "allow") for n, u in enumerate(URLS)), key=repr)


def plain_rules(rows, min_support, min_confidence, min_rows, max_size=3):
    """Every token set of a few tokens, counted."""
    from itertools import combinations
    total, bad = Counter(), Counter()
    for tokens, is_bad in rows:
        for size in range(1, max_size + 1):
            for c in combinations(sorted(tokens), size):
                total[c] += 1
                bad[c] += is_bad
    good = {c for c, n in bad.items() if n >= max(min_rows, min_support * len(rows)) and n / total[c] >= min_confidence}
    return {(c, bad[c], bad[c] / total[c]) for c in good if not any(set(d) < set(c) for d in good)}


def test_rules_equal_all_combinations(spark):
    rng = random.Random(16)
    rows = [(sorted(rng.sample("abcdefghij", rng.randint(0, 6))), rng.random() < 0.5) for _ in range(200)]
    rows = [(t, b or {"a", "b", "c"} <= set(t) or {"d", "e"} <= set(t)) for t, b in rows]
    df = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    for support, confidence, least in ((0.01, 0.6, 5), (0.05, 0.8, 3), (0.002, 0.95, 2)):
        got = urls.mine_rules(df, support, confidence, 3, least).collect()
        assert {(tuple(r.tokens), r.support_rows, r.confidence) for r in got} == plain_rules(rows, support, confidence, least)
        assert all(r["size"] == len(r.tokens) for r in got) and got


def test_long_repeated_urls_are_mined_in_seconds(spark):
    """Forty tokens in thirty equal urls, and thirty that each lack one of them."""
    import time

    words = [f"w{k}" for k in range(40)]
    rows = [(words, True)] * 30 + [(words[:k] + words[k + 1:], True) for k in range(30)] + [(words, False)] * 50 + [(["x"], False)] * 100
    began = time.time()
    got = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert time.time() - began < 120 and got == []
    rows = [(words, True)] * 30 + [(["x"], False)] * 100
    got = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert sorted(r.tokens[0] for r in got) == sorted(words) and {r["size"] for r in got} == {1}


def test_mined_rules(spark):
    """Labels that depend on token pairs give exactly these rules; support and confidence
    prune the rest."""
    rng = random.Random(6)
    pages, labels = [], []
    for n in range(600):
        host = rng.choice(["a.org", "b.org", "c.org"])
        word = rng.choice(["win", "news", "shop", "blog"])
        pages.append((n, f"http://{host}/{word}/{n}"))
        labels.append((n, 0 if (host == "a.org" and word == "win") or rng.random() < 0.05 else 1, 0))
    pages += [(900, "http://a.org/win/x"), (901, "http://b.org/win/x"), (902, None)]
    p = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels + [(None, 0, 0), (700, None, None)], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(p, marks).collect()}
    assert all(got[i] == (None, "block" if u and "a.org/win/" in u else "allow") for i, u in pages)
    assert {r.verdict for r in urls.judge_urls(p, marks.limit(0)).collect()} == {"allow"}
    assert urls.judge_urls(p.limit(0), marks).count() == 0


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "assistant", "again"), (1, 3, "user", None), (2, 5, "system", "<s>be</s> [INST]"), (2, 1, "user", "a\\[INST] <\\/s> [\\\\/INST]"),
         (2, 7, "assistant", "<</s>[[INST]/INST]</s>\n"), (3, 1, None, "no role"), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a"), (3, 1, "assistant", "tie a"), (None, 1, "user", "null id"),
         (4, None, "assistant", "null turn"), (4, 0, "user<s>", "odd role"), (5, 1, "assistant", "x" * 20000), (6, 1, "assistant", ""), (6, 2, "assistant", "")]


def test_chats(spark):
    df = spark.createDataFrame([(*c, "t") for c in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    got = rows_of(chat.chat_digest(chat.format_chats(df)).drop("formatted_chars"))
    want = []
    for conv in {c[0] for c in CHATS}:
        ts = sorted(((c[1] is not None, c[1] or 0, c[2] or "", c[3] or "") for c in CHATS if c[0] == conv))
        loss = "".join(t for *_, r, t in ts if r == "assistant")
        want.append((conv, len(ts), sha("".join(f"{r}\n{t}\n" for *_, r, t in ts)), len(loss), sha(loss)))
    assert got == sorted(want, key=repr)
    one = {r.conv_id: r.formatted for r in chat.format_chats(df).collect()}
    assert one[1] == "<s>user[INST]hi[/INST]</s><s>assistant[INST]hello[/INST][INST]again[/INST]</s><s>user[INST][/INST]</s>"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_running_totals(spark):
    rows = [(n, [{"chars": k % 7, "bytes": 3 * k} for k in range(n)]) for n in (0, 1, 2, 3, 8, 9, 1000)]
    df = spark.createDataFrame(rows, "n int, xs array<struct<chars:int,bytes:int>>")
    for r in df.select("n", chat.running_totals(df.xs).alias("t")).collect():
        assert [tuple(x) for x in r.t] == list(zip(itertools.accumulate(k % 7 for k in range(r.n)), itertools.accumulate(3 * k for k in range(r.n))))


def test_loss_spans_in_code_points_and_bytes(spark):
    texts = ["né </s>", None, "", "中[INST]", "\U0001f600 end", "<s>"]
    rows = [(1, n, role, t) for n, (role, t) in enumerate(zip(["user", "assistant", "assistant", "user", "assistant", "assistant"], texts))]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()[0]
    want = ["", "", "\U0001f600 end", "<\\s>"]
    raw = got.formatted.encode()
    assert [got.formatted[x.start:x.start + x.len] for x in got.loss_spans] == want
    assert [raw[x.byte_start:x.byte_start + x.byte_len].decode() for x in got.loss_spans] == want


@pytest.mark.parametrize("one_role", [False, True])
def test_conversation_of_very_many_turns(spark, one_role):
    n = 50_000
    rows = [("assistant" if one_role or k % 2 else "user", f"[INST] é {k}") for k in range(n)]
    role = "'assistant'" if one_role else "IF(id % 2 = 1, 'assistant', 'user')"
    df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", f"{role} AS role", "concat('[INST] é ', id) AS text")
    began = time.monotonic()
    got = chat.chat_digest(chat.format_chats(df)).collect()
    assert time.monotonic() - began < 30  # a copy of the list at every turn takes minutes
    loss = "".join(t for r, t in rows if r == "assistant")
    assert [(r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got] == [
        (n, sha("".join(f"{r}\n{t}\n" for r, t in rows)), len(loss), sha(loss))]
