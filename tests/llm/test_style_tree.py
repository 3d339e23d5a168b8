"""Main text of pages against pages built from known parts."""

import html
import math
import random
import re
from collections import Counter

import pytest

from barloom.llm import style_tree
from barloom.llm.frames import table
from barloom.llm.style_tree import extract_text, main_text, parsed, style_importance

SCHEMA = "page_id long, url string, html string, text string, path int, host string"


def words(pick, n):
    return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(3, 9))) for _ in range(n))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a&nbsp;b<b>c</b>d<p>e", "a bcd e"),
        ("x &lt;b&gt; &amp;amp; &#233;&am &amp", "x <b> &amp; é&am &"),
        ("<div class=CookieNotice>x</div><main>y\n z<aside>q</aside></main>w", "y z"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
        ("<script>'</p>' x</script><style>p{}</style><title>t</title><!-- c --><textarea>f</textarea>v<!-- open", "v"),
        ("<header>site</header><article><header><h1>T</h1></header><p>x<footer>by</footer></article>", "T x"),
        ("<section class='user comments'><article class=comment>no</article></section><article>yes</article>", "yes"),
        ("<form><main>kept</main></form><form>gone</form>", "kept"),
        ("<div hidden>h</div><div style='display: none'>h</div><div aria-hidden=true>h</div>v", "v"),
        ("a < b", "a < b"),
        ("<a title=it's href=x>q</a> r", "q r"),
        ("<div>" * 2000 + "deep", "deep"),
        ("", ""),
        ("<p", ""),
    ],
)
def test_one_page(page, want):
    assert main_text(parsed(page), set()) == want


def test_given_pages(spark, sf):
    rows = table(spark, sf, "pages").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in extract_text(table(spark, sf, "pages")).collect()}
    for r in rows:
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub("</?(?:p|br|h1)>", "\n", re.sub("</?b>", "", article))).split())
        assert got[r["page_id"]] == (r["url"], want, len(want))
    assert len(got) == len(rows)


def test_unmarked_template_branches(spark, monkeypatch):
    """No mark tells the template's branches; they repeat on a host, or rotate through all hosts."""
    pick = random.Random(4)
    adverts = [words(pick, 8) for _ in range(12)]
    rows, want = [], {}
    for host, n in (("one.example", 300), ("two.example", 60), ("three.example", 40)):
        bar = words(pick, 6)
        for k in range(n):
            body = [words(pick, pick.randint(5, 60)) for _ in range(pick.randint(1, 6))]
            if k % 4 == 0:
                body[0] = "the same first paragraph of many articles"
            page = f"<div class=xq{k}><span class=u>{bar}</span></div><div class=zz><h2>{words(pick, 3)}</h2>" + "".join(f"<p>{x}" for x in body)
            title = re.search("<h2>(.*?)</h2>", page)[1]
            rows.append((len(rows), f"http://www.{host}/{k}", f"<body>{page}</div><div class=b><em>{pick.choice(adverts)}</em></div>", "", 1, ""))
            want[rows[-1][0]] = " ".join([title, *body])
    frame = spark.createDataFrame(rows, SCHEMA)
    for sent in (style_tree.SENT_NODES, 0):  # the lists sent to every task, or joined in salted groups
        monkeypatch.setattr(style_tree, "SENT_NODES", sent)
        monkeypatch.setattr(style_tree, "GROUP_PAGES", 70)
        assert {r["page_id"]: r["text"] for r in extract_text(frame).collect()} == want


def test_importance(spark):
    rows = [(k, "https://h.example:80/x", f"<div id=a><p>{'same' if k % 2 else k}</p></div>", "", 1, "") for k in range(16)]
    seen = {(r["host"], r["pages"]): r for r in style_importance(spark.createDataFrame(rows, SCHEMA)).collect()}
    row = seen["h.example", 16]
    assert (row["shapes"], row["presentation"]) == (1, 0.0)
    found = Counter("same" if k % 2 else k for k in range(16))
    content = 1 - sum(math.log(n) / math.log(16) for n in found.values()) / len(found)
    assert row["content"] == pytest.approx(content)
    assert row["importance"] == pytest.approx(0.1 * content + 0.9 * content)
    assert seen[None, 16]["content"] == pytest.approx(content)


def test_odd_rows(spark):
    long = "<article>" + "<p>word word</p>" * 60_000
    rows = [(1, None, None, "t", 1, "h"), (None, "", "<p>x", "t", 1, "h"), (2, "no address", "<p>y", "t", 1, "h"), (2, "no address", "<p>y", "t", 1, "h"), (3, "http://h", long, "t", 1, "h"), (4, "http://h", "", None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["page_id"] or 0), r["url"], r["text"][:9], r["n_chars"]) for r in extract_text(frame).select("page_id", "url", "text", "n_chars").collect() if r["url"] is not None)
    assert got == [(0, "", "x", 1), (2, "no address", "y", 1), (2, "no address", "y", 1), (3, "http://h", "word word", 599_999), (4, "http://h", "", 0)]
    assert extract_text(frame.where("page_id = 1")).collect()[0]["text"] == ""
    assert extract_text(frame.limit(0)).count() == 0
