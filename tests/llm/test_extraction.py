import html
import re

import numpy as np

from tallygrain.llm import extraction, label_lstm
from tallygrain.llm.html_blocks import blocks, vectors


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_and_odd_pages():
    assert texts("") == [] and texts("   \n") == []
    assert texts("just &amp; text &lt;p&gt; &#233;&copy") == ["just & text <p> é©"]
    assert texts("<p>one<b>two</b> three<br>four<p>five") == ["onetwo three four", "five"]
    assert texts("<head><title>no</title></head><body>yes<script>if (a<b) {'</p>'}</script> more</body>") == ["yes more"]
    assert texts("<style>p{}</style><!-- <p>no</p> -->a<!-- open") == ["a"]
    assert texts("a < b <p>c <3 d") == ["a < b", "c <3 d"]
    assert texts("<p class='x>y' title=\"a>b\">t</p>") == ["t"]
    assert texts('<p class="open>text</p><p>next</p>')[-1] == "next"
    assert texts("<ul><li>a<li>b</ul></div></p>c") == ["a", "b", "c"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts("<title>x<body>lost") == []
    assert texts("<head><meta><body><p>kept") == ["kept"]
    assert texts("<textarea>no</textarea><svg><text>no</text></svg>ok") == ["ok"]
    assert texts("a\xa0 b\n\tc") == ["a b c"]
    assert texts("<" * 50_000) == ["<" * 50_000]


def test_paths_know_open_elements():
    found = blocks("<body><div class='Post main'><p><b>x<p>y</div><nav id=top>z</nav>")
    assert [b.path for b in found] == [["body", "div", "post", "main", "p", "b"], ["body", "div", "post", "main", "p"], ["body", "nav", "top"]]
    assert [b.tag for b in found] == ["p", "p", "nav"]
    assert blocks("<p><a>link</a>text</p>")[0].linked == 0.5


def test_gradients():
    rng = np.random.default_rng(0)
    pages = [rng.normal(size=(n, 6)).astype(np.float32) for n in (3, 5)]
    x, mask = label_lstm.padded(pages)
    p = {k: v.astype(float) for k, v in label_lstm.start(6, 3).items()}
    w = rng.normal(size=mask.shape)

    def loss():
        return float((label_lstm.forward(p, x, mask)[0] * w * mask).sum())

    q, (z, h, tape_f, tape_b) = label_lstm.forward(p, x, mask)
    d = w * mask * q * (1 - q)
    zf, gwf, gvf = label_lstm._unwind((d[:, :, None] * p["o"])[:, :, :3], tape_f, p["wf"])
    zb, gwb, gvb = label_lstm._unwind((d[:, :, None] * p["o"])[:, :, 3:], tape_b, p["wb"])
    ge = np.einsum("tbi,tbh->ih", x, (zf + zb) * (1 - z**2))
    for name, g in (("wf", gwf), ("vf", gvf), ("wb", gwb), ("vb", gvb), ("e", ge)):
        at = np.unravel_index(rng.integers(p[name].size), p[name].shape)
        p[name][at] += 1e-3
        up = loss()
        p[name][at] -= 2e-3
        down = loss()
        p[name][at] += 1e-3
        assert abs((up - down) / 2e-3 - g[at]) < 2e-2 * max(0.05, abs(g[at]))


def article(page):
    """The article of the given pages by their own markup."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?p>|</?h1>", inner)
    plain = [" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
    return "\n".join(p for p in plain if p)


def test_given_pages_and_other_layouts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    odd = [(9001, None, None), (9002, "u", ""), (9003, "u", "<p>"), (None, "u", "<nav><a>Home</a></nav>")]
    rows = extraction.extracted(pages.union(spark.createDataFrame(odd, pages.schema)).selectExpr("*", "1 as text", "2 as n_chars", "'x' as HTML")).collect()
    assert len(rows) == len(sources) + 4
    good = sum(r.text == article(sources[r.page_id]) for r in rows if r.page_id in sources)
    assert good >= 0.98 * len(sources)
    assert all(r.n_chars == len(r.text) for r in rows)
    assert [r.text for r in rows if r.page_id in (9001, 9002, 9003)] == ["", "", ""]

    model = extraction.learn(pages)
    fresh = extraction.drawn([b.text for h in sources.values() for b in blocks(h) if len(b.text) > 40], 150, 99)
    found = label_lstm.predict(model, [vectors(f) for _, f, _ in fresh])
    wrong = np.concatenate([(q >= 0.5) != (y > 0) for q, (_, _, y) in zip(found, fresh, strict=True)])
    assert wrong.mean() < 0.03
    assert extraction.extracted(pages.limit(0)).count() == 0
