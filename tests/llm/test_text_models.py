"""Toxicity, benchmark overlaps and main text: held-out accuracy, brute force, planted cases."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from tidewarden.llm import htmlblocks, toxicity
from tidewarden.llm.decontaminate import Index, Rule, contamination, overlaps, without_contaminated
from tidewarden.llm.tokens import words

SMALL = toxicity.Shape(buckets=1 << 10, width=6, filters=3, epochs=3)


def test_gradients_equal_differences():
    rng = np.random.Generator(np.random.PCG64(1))
    network = toxicity.Network(toxicity.Shape(buckets=64, width=4, filters=2, spans=(1, 2, 3)))
    for p in network.parameters():
        p += rng.normal(0, 0.3, p.shape).astype(np.float32)
    network.embedding = network.embedding.astype(np.float64)
    network.kernels = [k.astype(np.float64) for k in network.kernels]
    texts = pa.array(["ba cen di", "fo ba", "gu", "", "la mer nit sol tra"])
    features, place, bounds = toxicity.hashed_words(texts, 64)
    target, weight = np.array([1.0, 0, 1, 0, 1]), np.ones(5)

    def loss():
        p = network.probability(features, place, bounds)
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean())

    used, grads = network.gradients(features, place, bounds, target, weight)
    whole = np.zeros_like(network.embedding)
    whole[used] = grads[0]
    for parameter, grad in zip(network.parameters(), [whole, *grads[1:]], strict=True):
        for at in rng.choice(parameter.size, min(parameter.size, 12), replace=False):
            place_ = np.unravel_index(at, parameter.shape)
            kept = parameter[place_]
            parameter[place_] = kept + 1e-3
            up = loss()
            parameter[place_] = kept - 1e-3
            down = loss()
            parameter[place_] = kept
            assert grad[place_] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def toxic_corpus(n=1500):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text = frames.sentence(rng, rng.randrange(10, 120)).split()
        toxic = rng.random() < 0.2
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["grolk", "grolkish", "vexnor"]))
        rows.append((i, " ".join(text), rng.choice(["en", "de"]), "a"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxic_held_out_documents_are_found(spark):
    rows, labels = toxic_corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(frames.documents(spark, rows), known).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert sum(r.rejected == bool(truth[r.doc_id]) for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in out)


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    rows, labels = toxic_corpus(400)
    shape = "doc_id long, quality int, toxic int"
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    moved = [(i, t, "xx", "zz") for i, t, *_ in rows]
    score = lambda d, x: {r.doc_id: r.score for r in toxicity.toxicity(frames.documents(spark, d), spark.createDataFrame(x, shape)).collect()}
    assert score(rows, labels) == score(moved, turned)


def test_best_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.7, 0.2, 0.1]), np.array([1.0, 1, 0, 0])) == pytest.approx(0.45)
    assert 0.5 < toxicity.best_threshold(np.array([0.5, 0.5, 0.8]), np.array([0.0, 0, 1])) <= 0.8


def test_thresholds_count_all_rows_at_their_share(spark):
    """The fit has seen four of five toxic rows and no other; each row left over stands for five."""
    rng = np.random.Generator(np.random.PCG64(3))
    toxic = (rng.random(4000) < 0.05).astype(int)
    score = 1 / (1 + np.exp(3 - 3 * toxic - rng.normal(0, 1, 4000)))
    rows = [(i, "en" if i % 3 else "de", float(x)) for i, x in enumerate(score)]
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    seen = (toxicity.F.col("toxic") == 1) & (toxicity.F.col("doc_id") % 5 != 0)
    model = toxicity.Model(toxicity.Network(SMALL), 0.05, {}, 0.5)
    toxicity.calibrate(model, spark.createDataFrame(rows, "doc_id long, lang string, score double"), labels, seen, bins=1 << 20)
    left = np.flatnonzero((toxic == 0) | (np.arange(4000) % 5 == 0))

    def plain(at):
        scale = toxic[at].sum() / toxic[np.intersect1d(at, left)].sum()
        order = np.intersect1d(at, left)[np.argsort(-score[np.intersect1d(at, left)])]
        hits = np.cumsum(toxic[order]) * scale
        best = int(np.argmax(2 * hits / (hits + np.cumsum(1 - toxic[order]) + hits[-1])))
        return (score[order[best]] + score[order[best + 1]]) / 2

    every = np.arange(4000)
    assert model.threshold == pytest.approx(plain(every))
    assert model.thresholds.keys() <= {"en", "de"} and "en" in model.thresholds
    for name, at in (("en", every[every % 3 > 0]), ("de", every[every % 3 == 0])):
        assert name not in model.thresholds or model.thresholds[name] == pytest.approx(plain(at))


def test_languages_get_thresholds_from_rows_beyond_the_sample(spark):
    rows, labels = toxic_corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(frames.documents(spark, rows), known, most_rows=80).collect()
    lang = {i: x for i, _, x, _ in rows}
    assert len({(lang[r.doc_id], r.threshold) for r in out}) == len({r.threshold for r in out}) == 2


ITEMS = "item_id long, text string"


def planted(seed=2):
    """(documents, items, item ids in each document): whole items, replaced words, parts, short items."""
    rng = random.Random(seed)
    items = [(k, frames.sentence(rng, rng.randrange(16, 60))) for k in range(40)] + [(100, "bark cemu difo gulo merxi solst"), (101, "ban bark"), (102, "x")]
    rows, truth = [], {}
    for i in range(300):
        text = frames.sentence(rng, rng.randrange(5, 200)).split()
        if i % 3 == 0:
            k, item = items[rng.randrange(40)]
            part = item.split()
            if i % 2:
                for at in rng.sample(range(len(part)), len(part) // 10):
                    part[at] = "other"
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
            truth[i] = {k}
        elif i % 50 == 1:
            text[3:3] = items[40][1].upper().split()
            truth[i] = {100}
        rows.append((i, ("," if i % 4 else "\n").join(text), "en", "a"))
    rows += [(1000, "ban bark x", "en", "a"), (1001, None, None, None), (1002, items[0][1] + " " + items[0][1] + " " + items[1][1], "en", "a")]
    return rows, items, truth | {1002: {0, 1}}


def test_planted_items_are_found_and_nothing_else(spark):
    rows, items, truth = planted()
    out = contamination(frames.documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {r.doc_id: set(r.item_ids) for r in out if r.contaminated} == truth
    assert all((r.n_items, r.longest > 0) == (len(r.item_ids), r.contaminated) for r in out)


def test_a_benchmark_too_large_to_send_finds_the_same(spark):
    rows, items, truth = planted(3)
    docs, bench = frames.documents(spark, rows), spark.createDataFrame(items, ITEMS)
    kept = without_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows} - set(truth)

    found = overlaps(docs, bench, "hits", sent_bytes=300).collect()
    assert {r.doc_id: {h.item_id for h in r.hits} for r in found if r.hits} == truth


@pytest.mark.parametrize("pack_bytes", [1, 500, 1 << 20])
def test_joined_overlaps_equal_those_of_sent_items(spark, pack_bytes):
    """Odd rows and columns, repeated rows, an item id with two texts, null items, a word that all texts and items share."""
    rows, items, _ = planted(5)
    often = "ban " * 14
    rows = [(i, f"{t} {often}" if i % 4 == 0 else t, x, s) for i, t, x, s in rows if t] + rows[:30] + frames.odd_rows()
    items = [*items, (3, items[4][1]), (7, f"{often}{items[8][1]}"), (8, items[8][1]), (8, items[8][1]), (None, items[1][1]), (9, None), (9, "")]
    docs = frames.clashing(frames.documents(spark, rows)).withColumnRenamed("hits", "row_to_search").repartition(3)
    bench = spark.createDataFrame(items, ITEMS)
    told = lambda df: sorted(((tuple(r)[:-1], sorted(map(tuple, r.found))) for r in df.collect()), key=repr)
    sent = told(overlaps(docs, bench, "found"))
    joined = overlaps(docs, bench, "found", sent_bytes=0, pack_bytes=pack_bytes)
    assert joined.columns == [*docs.columns, "found"]
    assert told(joined) == sent
    assert len(sent) == len(rows) and sum(len(found) > 0 for _, found in sent) > 100
    none = overlaps(docs.limit(0), bench, "found", sent_bytes=0)
    assert none.count() == 0 and none.columns == joined.columns
    nothing = spark.createDataFrame([(1, "")], ITEMS)
    assert overlaps(docs, nothing, "found", sent_bytes=-1).filter("size(found) > 0").count() == 0


@pytest.mark.parametrize("n", [5, 6, 13, 15])
def test_joined_overlaps_find_replaced_words_at_every_place(spark, n):
    item = [f"w{k}" for k in range(n)]
    texts = [
        " ".join(["before", *("other" if k in places else word for k, word in enumerate(item)), "behind"])
        for replaced in range(1, n // 5 + 1)
        for places in itertools.combinations(range(n), replaced)
    ]
    docs = frames.documents(spark, [(i, text, "en", "a") for i, text in enumerate(texts)])
    found = overlaps(docs, spark.createDataFrame([(7, " ".join(item)), (8, "quite another text of words")], ITEMS), "hits", sent_bytes=0)
    assert [r.n for r in found.select(F.size("hits").alias("n")).collect()] == [1] * len(texts)


def test_a_common_passage_repeated_in_one_text(spark):
    item = "ban ban ban ban ban ban ban ban ban ban ban ban ban ban ban ban"
    docs = frames.documents(spark, [(1, "ban " * 20_000, "en", "a"), (2, "ban " * 12, "en", "a")])
    out = {r.doc_id: r.contaminated for r in contamination(docs, spark.createDataFrame([(1, item)], ITEMS)).collect()}
    assert out == {1: True, 2: False}


@pytest.mark.parametrize("n", [5, 6, 9, 10, 13, 14, 15, 18, 20, 22])
def test_replaced_words_at_every_place(n):
    """Every choice of places for as many replaced words as the rule allows, in items found whole in a text."""
    item = [f"w{k}" for k in range(n)]
    index = Index([7], pa.array([" ".join(item)]), Rule())
    texts = []
    for replaced in range(1, n // 5 + 1):
        for places in itertools.combinations(range(n), replaced):
            part = ["other" if k in places else word for k, word in enumerate(item)]
            texts.append(" ".join(["before", "it", *part, "behind"]))
    values, bounds, *_ = words(pa.array(texts, pa.large_string()))
    found = index.found(values, bounds)
    assert sorted(found) == list(range(len(texts)))
    assert all(equal >= 0.8 * size and size >= min(13, n) for [(_, _, size, equal)] in found.values())


@pytest.mark.parametrize("n", [5, 8, 12, 13, 15, 16, 30])
def test_found_equals_all_segments(n):
    """Items with words left as they are by chance, against the rule tried on every segment of the alignment."""
    rng = random.Random(n)
    item = [f"w{k}" for k in range(n)]
    index = Index([7], pa.array([" ".join(item)]), Rule())
    kept = [[rng.random() < share for _ in item] for share in (0.6, 0.7, 0.75, 0.8, 0.85) for _ in range(200)]
    texts = [" ".join(word if same else "other" for word, same in zip(item, row, strict=True)) for row in kept]
    least = min(13, n)
    counts = lambda row: any(
        5 * sum(row[i:j]) >= 4 * (j - i) for i in range(n) for j in range(i + least, n + 1)
    )
    values, bounds, *_ = words(pa.array(texts, pa.large_string()))
    assert set(index.found(values, bounds)) == {i for i, row in enumerate(kept) if counts(row)}


def test_the_longest_overlap_of_an_item_is_told(spark):
    item = " ".join(f"w{k}" for k in range(40))
    text = f"{' '.join(item.split()[5:19])} between {item} behind"
    hits = overlaps(frames.documents(spark, [(1, text, "en", "a")]), spark.createDataFrame([(7, item)], ITEMS), "hits").first().hits
    assert [(h.item_id, h.start, h.words, h.equal) for h in hits] == [(7, 15, 40, 40)]


def test_items_of_scripts_without_blanks(spark):
    item = "这是一个用来测试的句子，里面没有空格。"
    rows = [(1, f"前面的话{item}后面的话", "zh", "a"), (2, item.replace("测试", "检查").replace("，", ","), "zh", "a"), (3, "完全不同的一句话，和它没有关系。", "zh", "a")]
    out = {r.doc_id: r.contaminated for r in contamination(frames.documents(spark, rows), spark.createDataFrame([(1, item)], ITEMS)).collect()}
    assert out == {1: True, 2: True, 3: False}


def test_stricter_rule(spark):
    rows, items, truth = planted()
    out = contamination(frames.documents(spark, rows), spark.createDataFrame(items, ITEMS), Rule(identity=1.0, least_words=30)).collect()
    assert {r.doc_id for r in out if r.contaminated} < set(truth)


def page(rng, k):
    """(html, main text) in one of several layouts, all with names for the article."""
    paragraphs = [frames.sentence(rng, rng.randrange(3, 60)) + "." for _ in range(rng.randrange(1, 9))]
    title = frames.sentence(rng, 5)
    frame = lambda n: frames.sentence(rng, n)
    nav = "".join(f"<li><a href='/{frame(1)}'>{frame(2)}</a>" for _ in range(6))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}" + ("</p>" if k % 2 else "") for p in paragraphs)
    html = (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p><p>no';</script></head>"
        f"<body><nav><ul>{nav}</ul></nav><!-- <p>{frame(5)}</p> --><div class=\"ad\">{frame(6)}</div><article>{body}</article>"
        f"<footer>&copy; {frame(3)}</footer></body></html>"
    )
    return html, "\n".join([title, *paragraphs])


PAGES = "page_id long, url string, html string"


def test_main_text_of_unseen_pages(spark):
    rng = random.Random(5)
    made = [page(rng, k) for k in range(300)]
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(made)]
    rows += [(900, None, None), (901, "u", ""), (902, "u", "plain text, no markup"), (None, "u", "<p>broken <b"), (903, "u", "<div>" * 3000 + "deep")]
    out = htmlblocks.main_text(spark.createDataFrame(rows, PAGES), sample_pages=150, shape=htmlblocks.Shape(epochs=4))
    got = {r.page_id: r for r in out.collect()}
    assert len(got) == len(rows)
    right = sum(got[k].text == text for k, (_, text) in enumerate(made))
    assert right >= 0.99 * len(made), right
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[900].text == got[901].text == ""


def test_other_layouts(rng=random.Random(11)):
    """Lists, quotes and headers inside the article; comments, notices and forms around it; other names, or none."""
    labeller = htmlblocks.train([page(rng, k)[0] for k in range(200)])
    words = lambda n: frames.sentence(rng, n)
    frame = {
        "soup": ("<div class='top menu'><ul><li><a href=a>{}</a></ul></div><div class='post content'>", "</div><div class=sidebar><p>{}</p></div>"),
        "comments": ("<header><p>{}</p></header><article>", "</article><section class=comments><div class=comment><p>{}</p></div></section>"),
        "notice": ("<div class='cookie notice'>{}</div><main>", "</main><form><label>{}</label></form><footer>{}</footer>"),
    }
    wrong = total = 0
    for k in range(60):
        before, after = list(frame.values())[k % 3]
        main = [words(6), *[words(rng.randrange(8, 40)) + "." for _ in range(6)]]
        inner = f"<header><h1>{main[0]}</h1></header><p>{main[1]}</p><ul><li>{main[2]}</li><li>{main[3]}</li></ul><blockquote>{main[4]}</blockquote><p>{main[5]}</p><p>{main[6]}</p>"
        whole = f"<html><body>{before.format(words(2))}{inner}{after.format(words(12), words(4))}</body></html>"
        found = htmlblocks.blocks(whole)
        kept = labeller.probabilities([htmlblocks.features(found, labeller.shape)])[0] >= 0.5
        wrong += sum(bool(x) != (b.text in main) for x, b in zip(kept, found, strict=True))
        total += len(found)
    assert wrong <= 0.02 * total, (wrong, total)


def test_blocks_decode_and_join():
    found = htmlblocks.blocks('<p>a &amp; b&nbsp;&#233;<br>c</p><p title=">x">d<b> e</b><div>f<a href="y">gh</a></div>tail <3 &lt;')
    assert [b.text for b in found] == ["a & b é c", "d e", "fgh", "tail <3 <"]
    assert found[2].linked == 2


@pytest.mark.parametrize(
    "hidden",
    [
        "<script>for(i=0;i<n;i++){f()}</script>", "<script>if (a<b) x = '<!-- ';</SCRIPT >", "<script>a = '<b title=\"';</script>",
        "<script>s = '<div class=\"' + c</script\n>", "<style>a:after{content:'<a'}</style>", "<script>x</scripts>y</script>", "<script/>",
        "<noscript><img src='a' alt='it's'></noscript>", "<svg><text>t</text></svg>", "<script>i<n</script><script>j<m</script>",
    ],
)
def test_hidden_content_is_not_cut_into_tags(hidden):
    assert [b.text for b in htmlblocks.blocks(f"<p>one</p>{hidden}<p>two</p><p>three</p>")] == ["one", "two", "three"]


@pytest.mark.parametrize("text", ["<", "<p", "<p title=\"a", "</", "<!--", "<!-- x", "<script>a", "&#xffffff; &bogus;", "<p/>x", "\x00<p>\x00"])
def test_broken_markup_is_read(text):
    assert isinstance(htmlblocks.blocks(text), list)


def test_no_page_names_its_article(spark):
    rows = [(1, "u", "<div class='menu'>x y</div><div>text of it</div>")]
    out = htmlblocks.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert [r.text for r in out] == ["text of it"]


def test_no_pages(spark):
    assert htmlblocks.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_labeller_gradients_equal_differences():
    rng = np.random.Generator(np.random.PCG64(4))
    shape = htmlblocks.Shape(buckets=50, width=3, hidden=3)
    labeller = htmlblocks.Labeller(shape)
    labeller.weights = {k: w.astype(np.float64) for k, w in labeller.weights.items()}
    pages = [htmlblocks.blocks("<div class=a>x y</div><p>some words here.</p><p>z</p>"), htmlblocks.blocks("<p>one</p>")]
    read, labels = [htmlblocks.features(p, shape) for p in pages], [np.array([0.0, 1, 1]), np.array([1.0])]
    kept = [tuple(np.ones(len(y), dtype=np.float32) for _ in range(2)) for y in labels]

    def loss():
        p = np.concatenate(labeller.probabilities(read))
        y = np.concatenate(labels)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    grads = labeller.gradients(read, labels, kept)
    for name, weight in labeller.weights.items():
        for at in rng.choice(weight.size, min(weight.size, 10), replace=False):
            place = np.unravel_index(at, weight.shape)
            before = weight[place]
            weight[place] = before + 1e-3
            up = loss()
            weight[place] = before - 1e-3
            down = loss()
            weight[place] = before
            assert grads[name][place] == pytest.approx((up - down) / 2e-3, abs=1e-3), name
