"""Operators that SQL cannot express, against plain versions on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from plumbline.llm import decontam, langid, lines, mixing, neardup, pagetext, pieces, pii, quality, scoring
from plumbline.llm.queries import ORACLES, QUERIES, vocabulary
from plumbline.llm.stored import components
from plumbline.llm.tokens import Powers
from tests import compare

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.difference(spark, compare.duck(SF_DIR), name, SF_DIR) is None


# -- 1


def test_ids_and_texts_are_the_library_s(spark, texts):
    model = pieces.model_bytes(vocabulary())
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    odd = ["", " ", "  a  b\n\n c", "▁a▁ b", "x\r\ny", "a" * 3000, "▁" * 40, " " * 77 + "x", "𝒳🎉é", "<s> </s> <0x0A>", "ab;\r\n", "\t ▁ \t", "été,là!!»«", "don't"]
    rows = list(enumerate([*odd, *texts.values()]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in rows}
    encoded = pieces.encoded(docs, model).cache()
    for r in encoded.collect():
        assert (list(r["ids"]), r["n_differing"]) == (want[r["doc_id"]], 0)
    assert all(r["text"] == library.decode(want[r["doc_id"]]) for r in pieces.decoded(encoded, model).collect())
    for r in pieces.round_trips(docs, model).collect():
        ids = want[r["doc_id"]]
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_both_agendas_merge_alike():
    agenda = pieces.Encoder(pieces.model_bytes(vocabulary())).agenda
    r = random.Random(3)
    for _ in range(500):
        segment = "".join(r.choice("▁abcdethineor.é") for _ in range(r.randint(1, 30)))
        assert agenda.encode(segment) == agenda._ids(agenda._many(list(segment)))


# -- 2


def plain_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15],
    }


def test_plain_identifiers(texts):
    detector, r = pii.Detector(), random.Random(1)
    made = ["".join(r.choice("ab1290.@+-  ()45é") for _ in range(r.randint(0, 40))) + r.choice(["", " 4111 1111 1111 1111"]) for _ in range(5000)]
    for text in [*made, *texts.values()]:
        assert detector.plain(text) == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "source", "value"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com", "john@example.com"),
        ("jane.doe at mail dot example dot org", "email", "jane.doe at mail dot example dot org", "jane.doe@mail.example.org"),
        ("é jоhn@exаmple.com", "email", "jоhn@exаmple.com", "john@example.com"),
        ("a​@b.c​om", "email", "a​@b.c​om", "a@b.com"),
        ("tel +４９ １７０ ５５５ １２３４.", "phone", "+４９ １７０ ５５５ １２３４", "+49 170 555 1234"),
        ("plus four nine one seven two three four five six", "phone", "plus four nine one seven two three four five six", "+491723456"),
        ("one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
        ("four " + "one " * 14 + "one", "card", "four " + "one " * 14 + "one", "4111111111111111"),
    ],
)
def test_disguised_identifiers(spark, text, kind, source, value):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (span,) = pii.personal_data(docs).first()["spans"]
    assert (span["kind"], text[span["start"] : span["end"]], span["value"], span["plain"]) == (kind, source, value, False)
    counted = pii.counted(pii.personal_data(docs)).first()
    assert (counted["n_disguised"], counted[f"n_{kind}"]) == (1, 0)
    assert counted["spans"] == f"{kind}:{span['start']}:{span['end']}"


@pytest.mark.parametrize("text", ["the man at the dot of noon", "one two three go", "he is at here dot there", "un deux trois", "(at) home"])
def test_ordinary_words_are_no_identifiers(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.personal_data(docs).first()["spans"] == []


# -- 3


def shingles(text):
    words = low(text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                high, lower = sorted((find(a), find(b)), reverse=True)
                label[high] = lower
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(seed, copies, edits):
    """A text and edited copies of it, some of them edited again."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    known = [[word() for _ in range(r.randint(60, 200))]]
    for _ in range(copies):
        words = list(r.choice(known))
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = word()
        known.append(words)
    return [" ".join(w) for w in known]


def test_components_of_similar_documents(spark, texts):
    made = [t for seed in range(6) for t in family(seed, 25, 6)] + family(9, 120, 5)
    every = dict(texts) | {1000 + i: t for i, t in enumerate(made)}
    docs = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_components(every)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "ROWS_OF_PAIRS", 3)
    monkeypatch.setattr(neardup, "BLOCK_NODES", 8)
    every = {i: t for i, t in enumerate(family(5, 90, 14) + family(6, 40, 12))}
    docs = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c) in brute_components(every).items()}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found} == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}


# -- 4


def test_unigram_scores(spark, texts):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    tokens = {i: [*low(t).encode().split(), b"\n"] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = scoring.scored(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        i = r["doc_id"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens[i])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(tokens[i]), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens[i])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    size = sum(len(texts[r["doc_id"]].encode()) + 1 for r in found if r["held_out"])
    bits = sum(-r["score"] / math.log10(2) for r in found if r["held_out"])
    assert bits / size < 3.5


def test_codes_are_a_distribution_and_learning_helps():
    powers = Powers()
    words = [b"the", b"then", b"there", b"cat", b"car"] * 1
    counts = np.array([50, 20, 10, 5, 5])
    tables = np.zeros((2, mixing.SLOTS))
    mixing.counted(words, counts, tables, powers)
    mixer = mixing.Mixer()
    mixer.learn(words, counts, tables, powers)
    empty = mixing.log_odds(np.zeros((2, mixing.SLOTS)))
    known = mixing.log_odds(tables)
    # Words of one byte: the code of a word is that of its byte and of a blank.
    found = mixing.events([bytes([b]) for b in range(256) if b != 10], powers)
    gate = found.place * mixing.TRUST + known[1][found.slots[-1] - mixing.OFFSETS[-2]]
    p = mixer._refined(mixer._mixed(known[0][found.slots], gate), gate)
    chosen = np.where(found.bit == 1, p, 1 - p).reshape(-1, 2, 8)[:, 0].prod(axis=1)
    line_feed = mixing.events([mixing.END], powers)
    gate = line_feed.place * mixing.TRUST + known[1][line_feed.slots[-1] - mixing.OFFSETS[-2]]
    p = mixer._refined(mixer._mixed(known[0][line_feed.slots], gate), gate)
    assert chosen.sum() + np.where(line_feed.bit == 1, p, 1 - p).prod() == pytest.approx(1)
    assert mixer.lengths(words, *known, powers).sum() < 0.5 * mixing.Mixer().lengths(words, *empty, powers).sum()


# -- 6


def test_search_finds_all_above_the_threshold(spark):
    r = random.Random(2)
    vocabulary_ = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary_, weights=range(1, 61), k=r.randint(3, 90)))) for i in range(300)]
    postings = decontam.index(spark.createDataFrame(items, "item_id long, text string")).toPandas()
    index = decontam.Index(postings, [(i, t.encode()) for i, t in items])
    powers = Powers()
    for _ in range(60):
        passage = " ".join(r.choices(vocabulary_, k=r.randint(1, 60))).encode()
        found = decontam._terms([passage], powers)
        number = index.numbers(found.hashes)
        query = np.unique(number[number >= 0]).tolist()
        exact = Counter()
        for t in query:
            for unit, share in zip(*index.lists[t][:2]):
                exact[unit] += share
        for threshold in (0.2, 0.5, 0.8):
            want = {u: s for u, s in exact.items() if s >= threshold}
            got = index.search(query, threshold)
            assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in got)
        assert index._bounds(number, found.first)[0] >= max(exact.values(), default=0) - 1e-4


def test_planted_items_are_found(spark, texts):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    known = {r["item_id"]: r["text"] for r in items.collect()}
    clean = [t for t in texts.values() if not any(" ".join(k.split()[:6]) in " ".join(t.split()) for k in known.values())]
    rows = [(i, f"{clean[i]} {known[k].upper()} {clean[i + 1]}") for i, k in zip(range(20), sorted(known))]
    rows += [(100 + i, t) for i, t in enumerate(clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()}
    assert found == set(zip(range(20), sorted(known)))


# -- 8


def test_ablation(spark):
    book = spark.createDataFrame([(i, b) for i, b in enumerate([0, 0, 1, 2, 3, 4, 4, 12, 64])], "doc_id long, failed long")
    for policy, rules in quality.POLICIES.items():
        masks = [r["failed"] & quality.bits(rules) for r in book.collect()]
        for r in quality.ablation(book, policy).collect():
            bit = quality.bits([r["rule"]])
            assert r["failing"] == sum(m & bit > 0 for m in masks)
            assert r["only"] == sum(m == bit for m in masks)
            assert r["kept"] == sum(m == 0 for m in masks)
            assert r["kept_without"] == sum(m & ~bit == 0 for m in masks)


# -- 9


def test_main_text_of_pages(spark):
    import html

    found = {r["page_id"]: r["text"] for r in QUERIES["op9_page_text"](spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        parts = [re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert found[r["page_id"]] == "\n".join(t for t in want if t)


def test_pages_of_other_shapes(spark):
    page = (
        "<html><body><header><h1>Site</h1></header><div class=cookie-notice>We use cookies. Fine?</div>"
        "<main><h1>A&nbsp;title</h1><p>First &lt;b&gt;.<p>Two<br>lines <a href=x>and a link</a>.<ul><li>one<li>two</ul>"
        "<form>Name <input></form><script>var a = '<p>no</p>';</script>"
        "<section id=comments><p>Nice post. I like it very much, thanks.</p></section></main>"
        "<aside><p>Other stories. Many.</p></aside><footer>end</footer>"
    )
    docs = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    for model in (pagetext.fitted(docs), pagetext.fitted(spark.read.parquet(f"{SF_DIR}/pages.parquet"))):
        assert pagetext.main_texts(docs, model).first()["text"] == "A title\nFirst <b>.\nTwo lines and a link.\none\ntwo"


@pytest.mark.parametrize("apart", ["<nav>x</nav>", "<nav><ul><li>x. And more.</ul></nav>", "<aside><div><div><p>x. And more.</div></div></aside>"])
def test_marginals_are_exact(apart):
    nodes, _ = pagetext.blocks_of(f"<body><div class=content><p>Some text. More.</p><ul><li>a<li>b</ul></div>{apart}")
    model = pagetext.Model(pagetext.FIRST, pagetext.FIRST_EDGES)
    own = [0 if n.apart else sum(model.weights.get(k, 0) * v for k, v in pagetext._features(n).items()) for n in nodes]
    total, content = 0.0, np.zeros(len(nodes))
    for code in range(1 << len(nodes)):
        x = [(code >> i) & 1 for i in range(len(nodes))]
        if any(n.apart and x[i] for i, n in enumerate(nodes)):
            continue
        weight = math.exp(sum(o for o, label in zip(own, x) if label))
        for i, n in enumerate(nodes[1:], 1):
            row = model.edges[x[n.parent]]
            weight *= row[x[i]] / sum(row)
        total += weight
        content += weight * np.array(x)
    assert model.marginals(nodes) == pytest.approx((content / total).tolist(), abs=1e-6)


# -- 10


def test_languages(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    evidence = langid.document_evidence(docs)
    train = evidence.where("doc_id % 2 = 0")
    profile = langid.profiles(train)
    test = evidence.where("doc_id % 2 = 1 AND length(text) > 60")
    scores = test.select("doc_id", "text", F.lit(0).cast("long").alias("row_hash"), "declared", "host", "suffix").mapInArrow(
        lambda batches: langid._scored(batches, profile),
        "doc_id long, row_hash long, declared string, host string, suffix string, n_grams long, likelihoods array<double>",
    ).collect()
    right = [langid.LANGUAGES[int(np.argmax(r["likelihoods"]))] == r["declared"] for r in scores]
    assert np.mean(right) > 0.97


def test_other_evidence_decides_short_texts(spark):
    rows = [(i, "the house and the garden with the tree", "en", "e.example.com", None) for i in range(30)]
    rows += [(100 + i, "das haus und der garten mit dem baum", "de", "d.example.de", "de") for i in range(30)]
    rows += [(200, "in", None, "d.example.de", "de"), (201, "in", None, "e.example.com", None), (202, "xq", "de", None, None)]
    evidence = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string")
    found = {r["doc_id"]: r["language"] for r in langid.identified(evidence, ("en", "de")).collect()}
    assert [found[i] for i in (0, 100, 200, 201, 202)] == ["en", "de", "de", "en", "de"]


def test_evidence_of_pages(spark):
    pages = spark.createDataFrame([(1, "https://Www.Haus.example.de:80/x", '<HTML LANG="de-AT"><p>Das</p><script>no</script>')], "page_id long, url string, html string")
    r = langid.page_evidence(pages).first()
    assert (r["declared"], r["host"], r["suffix"], r["text"].split()) == ("de", "www.haus.example.de", "de", ["Das"])


# -- the pipeline


def brute_lines(texts):
    first = {}
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(key(line), i)
    return {
        i: "\n".join(x for x in t.split("\n") if len(key(x)) < lines.SHORTEST or first[key(x)] == i)
        for i, t in texts.items()
    }


def test_pipeline(spark, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns and kept.count() == len(texts)
    shortened = stages["line_dedup"](spark, docs, SF_DIR)
    got = {r["doc_id"]: r["text"] for r in shortened.collect()}
    assert shortened.columns == docs.columns and got == brute_lines(texts)
    got = {r["doc_id"] for r in stages["near_duplicates"](spark, docs, SF_DIR).collect()}
    assert got == {i for i, (_, c) in brute_components(texts).items() if c == i}
    clean = stages["decontamination"](spark, docs, SF_DIR)
    leaked = {r["doc_id"] for r in QUERIES["op6_decontamination"](spark, SF_DIR).collect()}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == set(texts) - leaked
    after = brute_lines(texts)
    alone = {i: after[i] for i, (_, c) in brute_components(after).items() if c == i}
    final = corpus_pipeline.run(spark, SF_DIR).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary())
    assert {r["doc_id"] for r in final} <= set(alone) and len(final) >= len(alone) - len(leaked)
    for r in final:
        ids = library.encode(alone[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
