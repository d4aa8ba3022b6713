"""Main text of pages: the parser, the labeller's gradient and its held-out accuracy, odd pages, the query's SQL."""

import duckdb
import numpy as np
import pytest

from wavelattice.llm import html_text as H
from wavelattice.llm.html_blocks import blocks

SF = "/root/testdata/sf0.1"
EMPTY_PAGE = "page_id bigint, url string, html string, text string, n_chars string, _html string, _h string"


@pytest.fixture(scope="module")
def pages():
    return [h for h, in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()]


@pytest.fixture(scope="module")
def weights(pages):
    return H.fit(pages[:200])


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_markup():
    assert texts("<p><b>one<br><p>two &amp; t<i>hr</i>ee<ul><li>a<li>b</ul>tail") == ["one", "two & three", "a", "b", "tail"]
    assert texts("<script>var t='</p>';<p>x</script>y<style>p{}</style><title>t</title><!-- <p>no</p> -->z") == ["yz"]
    assert texts("a <p title='x > y'>b</p> c < d && e <p") == ["a", "b", "c < d && e <p"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table><textarea>no</textarea>&nbsp; &#x41;&quot;&copy") == ["1", "2", "3", 'A"©']
    assert texts(None) == texts("") == texts("  <p> \n </p>") == texts("<script>never closed <p>x</p>") == []
    assert texts("<DIV><P>Up</P>" + "</div>" * 5 + "down</p></b>") == ["Up", "down"]


def test_paths_and_links():
    got = blocks('<body><div class="Side-bar x" id=menu><a href="#">to <b>go</b></a> now</div><p>after')
    assert got[0].path == ("body", "div", ".side", ".bar", ".x", ".menu") and got[0].text == "to go now" and got[0].linked == 5
    assert got[1] == (("body", "p"), "after", 0)


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(3)
    w = {k: v.astype(np.float64) for k, v in H.new_weights(rng, 3, 5).items()}
    sizes = [4, 1, 6]
    x, y, weight = rng.normal(size=(11, 5)), rng.integers(0, 2, 11).astype(float), rng.random(11) + 0.1
    _, grad = H.loss_and_gradient(x, sizes, y, weight, w)
    for name, v in w.items():
        for at in list(np.ndindex(v.shape))[::7]:
            up, down = {**w, name: v.copy()}, {**w, name: v.copy()}
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (H.loss_and_gradient(x, sizes, y, weight, up)[0] - H.loss_and_gradient(x, sizes, y, weight, down)[0]) / 2e-5
            assert grad[name][at] == pytest.approx(slope, abs=1e-6)


def test_sequences_do_not_depend_on_their_company():
    rng = np.random.default_rng(4)
    w, sizes = H.new_weights(rng, 4, 6), [3, 0, 7, 1]
    x = rng.normal(size=(11, 6)).astype(np.float32)
    whole = H.probabilities(x, sizes, w)
    alone = np.concatenate([H.probabilities(x[a:b], [b - a], w) for a, b in ((0, 3), (3, 10), (10, 11))])
    assert np.allclose(whole, alone, atol=1e-6)
    later = x.copy()
    later[9] += 1.0  # the last block of the second page changes its first one's label, and no other page's
    moved = H.probabilities(later, sizes, w)
    assert abs(moved[3] - whole[3]) > 1e-7 and np.allclose(moved[:3], whole[:3], atol=1e-6)


def test_held_out_pages_and_disguises(pages, weights):
    parsed = [blocks(p) for p in pages[1000:1600]]
    sizes, want = [len(p) for p in parsed], np.concatenate([H.taught(p)[0] for p in parsed])
    assert ((H.probabilities(H.vectors(parsed), sizes, weights) >= 0.5) == want).all()
    rng = np.random.default_rng(77)
    copies = [H.disguised(p, H.taught(p)[0], parsed, rng) for p in parsed]
    got = H.probabilities(H.vectors([c[0] for c in copies]), [len(c[0]) for c in copies], weights) >= 0.5
    assert (got == np.concatenate([c[1] for c in copies])).mean() > 0.999


def test_layout_that_no_page_has(weights):
    para = "Of ntth of, onhant nt, and ndednd thtind stenwh to an, inthwh thtionha th erheble of anedon."
    page = ("<html><body><div class='site-header'><a href='/'>Home page</a></div><div class='top-menu'><ul><li><a href=1>the</a><li><a href=2>and</a></ul></div>"
            f"<div class='post-content'><h1>Of ntth of</h1><p>{para}</p><p>{para[:40]}</p><div class='ad'>{para[:50]}</div><p>{para[10:]}</p></div>"
            f"<div id='comments'><p>{para[5:]}</p></div><form><label>Your name</label><button>Send</button></form><div id='footer'>&copy; the site</div>")
    got = [b.text for b, p in zip(blocks(page), H.probabilities(H.vectors([blocks(page)]), [len(blocks(page))], weights)) if p >= 0.5]
    assert got == ["Of ntth of", para, para[:40], para[10:]]


def test_odd_rows(spark, weights, pages):
    long = pages[0].replace("</article>", "<p>more of the article, and more.</p>" * 20000 + "</article>")
    rows = [(1, "u", None), (1, "u", ""), (2, None, "no tags at all"), (None, "v", pages[1]), (None, "v", pages[1]), (3, "w", long), (4, "x", "<p><p><div>")]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], EMPTY_PAGE)
    got = H.main_text(df, weights, ["page_id", "url"]).collect()
    assert [(r["page_id"], r["url"]) for r in got] == [r[:2] for r in rows] and got[0]["text"] == got[1]["text"] == got[6]["text"] == ""
    assert got[3] == got[4] and got[5]["text"].count("more of the article, and more.") == 20000
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    per_block = H.labelled_blocks(df, weights, ["page_id"]).where("page_id = 3").orderBy("place").collect()
    assert "\n".join(r["text"] for r in per_block if r["score"] >= 0.5) == got[5]["text"]
    empty = spark.createDataFrame([], EMPTY_PAGE)
    assert H.main_text(empty, H.train(empty), ["page_id", "url"]).collect() == []


def test_training_on_spark_is_bounded_and_repeatable(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    a, b = H.train(df, sample=20, epochs=1), H.train(df.repartition(7), sample=20, epochs=1)
    assert all(np.allclose(a[k], b[k], atol=1e-5) for k in a)
    assert H.train(df, sample=20, chars=10, epochs=1)["out"].shape == (2 * H.HIDDEN,)
