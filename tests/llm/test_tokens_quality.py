"""BPE, trie token counts, line CRF and class model against plain versions."""

import base64
import hashlib
import itertools
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, class_exchange, class_lm, line_crf, trie_tokens
from riskframe.llm.queries import ranks

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    pairs = (line.split() for line in ranks().splitlines() if line)
    merged = {base64.b64decode(t): int(r) for t, r in pairs}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merged, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


EDGES = [
    None, "", " ", "  ", "\n", "a b", " a", "a ", "a  b", "a\n b", "a \nb", "it's we'll", "<|endoftext|>", "\x00\x1c\x85 x",
    "漢字 かな 🙂👍", "é" * 999, "=" * 5000, " " * 3000 + "x", "ab" * 20000, "1234567890 " * 50, "\r\n\r\n x", "a\xa0 b",
]


def test_encoder_gives_the_ids_of_the_reference(reference):
    encoder = byte_bpe.Encoder(ranks(), PATTERN)
    rng = random.Random(7)
    alphabet = list("abe thing  \n\t129!?.'sßñ中🙂\x85\xa0_-=") + ["the", " un", "'ll", "  ", "\r\n"]
    texts = [t or "" for t in EDGES] + ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(3000)]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == packed(reference.encode_ordinary(text)), text
        assert encoder.decode(ids) == text.encode()


def test_full_memories_change_nothing(reference, monkeypatch):
    for name in ("MOST_PIECES", "MOST_PAIRS"):
        monkeypatch.setattr(byte_bpe, name, 3)
    encoder = byte_bpe.Encoder(ranks(), PATTERN)
    text = "some words and some more words, andsomelongerones " * 20
    assert encoder.encode(text) == packed(reference.encode_ordinary(text))


def test_encoding_a_table(spark, docs, reference):
    frame = docs(EDGES).repartition(3)
    found = {r.doc_id: r for r in byte_bpe.encode(frame, ranks(), PATTERN).collect()}
    told = {r.doc_id: r for r in byte_bpe.digests(frame, ranks(), PATTERN).collect()}
    for i, text in enumerate(EDGES):
        ids = packed(reference.encode_ordinary(text or ""))
        assert bytes(found[i].ids) == ids and bytes(found[i].decoded) == (text or "").encode()
        assert told[i].n_tokens == len(ids) // 4
        assert told[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert told[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    clash = frame.withColumn("row", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("n_tokens", F.lit(3))
    out = byte_bpe.tokenized(clash, ranks(), PATTERN)
    assert out.columns == [*frame.columns, "row", "ids", "n_tokens", "token_ids"]
    assert out.where("row = 1 AND ids = 2").count() == len(EDGES)
    assert byte_bpe.digests(docs([]), ranks(), PATTERN).count() == 0


PIECES = {"▁": -5, "▁a": -3, "a": -4, "b": -4, "ab": -5, "▁ab": -9, "bab": -6, "é": -7, "abab": -11}


def plain_tokens(word, pieces, spelled):
    """Best by score, then by fewer tokens, over all segmentations."""
    text, best = "▁" + word, None
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        parts, at = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append(text[at:i])
                at = i
        if all(p in pieces or len(p) == 1 for p in parts):
            score = sum(pieces.get(p, spelled * len(p.encode())) for p in parts)
            n = sum(1 if p in pieces else len(p.encode()) for p in parts)
            best = max(best or (score, -n), (score, -n))
    return -best[1], best[0]


def test_trie_matches_all_segmentations():
    trie = trie_tokens.Trie(PIECES)
    for n in range(1, 7):
        for letters in itertools.product("abéx", repeat=n) if n < 5 else [random.Random(i).choices("abéx", k=n) for i in range(60)]:
            word = "".join(letters)
            tokens, _, score = trie.insert("▁" + word)
            assert (tokens, score) == plain_tokens(word, PIECES, trie.spelled)


def test_prefixes_are_scored_once_and_small_tries_agree():
    trie = trie_tokens.Trie(PIECES)
    for word in ("abab", "ababb", "abaab", "abab"):
        trie.insert("▁" + word)
    assert len(trie.score) == 1 + len("▁abab") + 1 + 2
    small = trie_tokens.Trie(PIECES, most_nodes=12)
    words = ["ab" * 3, "ba", "éab", "x", "bab" * 3] * 5
    assert [small.insert(w) for w in words] == [trie.insert(w) for w in words]


def test_token_counts_of_a_table(spark, docs):
    texts = [None, "", "ab  b\x0bx", "b " * 30000, "é", "a\xa0b"]
    found = {r.doc_id: r for r in trie_tokens.count_tokens(docs(texts), PIECES).collect()}
    trie = trie_tokens.Trie(PIECES)
    for i, text in enumerate(texts):
        each = [plain_tokens(w, PIECES, trie.spelled)[0] for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        assert (found[i].n_words, found[i].n_tokens) == (len(each), sum(each))
    assert trie_tokens.count_tokens(docs([]), PIECES).count() == 0
    real = trie_tokens.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert len(real) > 30000 and max(real.values()) < 0


def brute_marginals(good, pairs):
    weights = {}
    for labels in itertools.product((0, 1), repeat=len(good)):
        score = sum(g for g, y in zip(good, labels) if y)
        weights[labels] = math.exp(score + sum(pairs[a][b] for a, b in zip(labels, labels[1:])))
    total = sum(weights.values())
    single = [sum(w for y, w in weights.items() if y[i]) / total for i in range(len(good))]
    moved = np.zeros((2, 2))
    for labels, w in weights.items():
        for a, b in zip(labels, labels[1:]):
            moved[a, b] += w / total
    return single, moved, math.log(total)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(8)
    lengths = np.array([1, 5, 2, 7, 1])
    good, pairs = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2))
    marginal, moved, total = line_crf.forward_backward(good, pairs, lengths)
    at = 0
    for i, n in enumerate(lengths):
        single, pair, log_total = brute_marginals(good[at : at + n], pairs)
        np.testing.assert_allclose(marginal[at : at + n], single)
        np.testing.assert_allclose(moved[i], pair, atol=1e-12)
        assert total[i] == pytest.approx(log_total)
        at += n


def test_features_stay_inside_documents():
    texts = ["A!\n$$ $$\n$$ $$", "", "x\n"]
    own, per, sizes = line_crf.line_features(texts)
    assert per.tolist() == [3, 1, 2] and sizes.tolist() == [2, 5, 5, 0, 1, 0]
    alone = [line_crf.line_features([t])[0] for t in texts]
    np.testing.assert_array_equal(own, np.vstack(alone))
    joined = line_crf.with_neighbours(own, per)
    parts = [line_crf.with_neighbours(a, np.array([len(a)])) for a in alone]
    np.testing.assert_array_equal(joined, np.vstack(parts))


def test_classifier_is_right_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    field = line_crf.train(documents, labels)
    judged = line_crf.judge(documents.repartition(3), field).join(labels, "doc_id").where("held_out")
    right, n = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert n > 50 and right > 0.95
    wrong = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    other = line_crf.train(documents, wrong)
    np.testing.assert_array_equal(field.weights, other.weights)


def test_classifier_edge_cases(spark, docs):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "\n" * 3000, "en", "s", 0), (3, "word " * 20000, "en", "s", 0)]
    frame = docs(rows).withColumn("score", F.lit("mine")).withColumn("row", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert line_crf.train(frame, labels) is None
    assert {r.score for r in line_crf.judge(frame, None).collect()} == {0.5}
    own, per, _ = line_crf.line_features(["good line\nnext", "$$$$ $$$$"] * 5)
    field = line_crf.fit_field(own, per, np.array([1, 0] * 5), rounds=40)
    scores = [r.score for r in line_crf.judge(frame, field).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert [r.held_out for r in line_crf.judge(frame.where("doc_id IS NULL"), field).collect()] == [False]
    assert line_crf.keep_good(frame, field).columns == frame.columns
    assert line_crf.judge(docs([]), field).count() == 0


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


@pytest.mark.parametrize("options", [{}, {"head": 5, "seeds": 3, "classes": 2}, {"seeds": 40, "classes": 4}])
def test_class_model_base_and_sums(spark, docs, options):
    rng = random.Random(9)
    vocabulary = ["the", "The", "cat", "Dog", "x1", "end.", "verylongwordhere", "é", "a", "runs"] + [f"w{i}" for i in range(40)]
    texts = [None, "", "THE the", "never seen here"] + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(80)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(5, texts[5], "en", "s", 0), (None, "the cat", "en", "s", 0)]
    found = class_lm.report(docs(rows).repartition(4), **options).collect()
    assert len(found) == len(rows)
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 and r[0] is not None for r in rows}
    counts = Counter(w for r in rows if not held[r[0]] for w in plain_words(r[1]))
    n, v = sum(counts.values()), len(counts)
    for r in found:
        words = plain_words("the cat" if r.doc_id is None else texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_class_model_scores_token_by_token(spark, docs):
    texts = ["a b a b a c", "b a d", "a b c d e f 99 end.", "e g h 99 g", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    model, others = class_lm.train(frame, classes=2, seeds=4, head=6)
    counts = Counter(w for t in texts for w in [*t.encode().split(), class_lm.END])
    place = {w: i for i, w in enumerate(model.head.index)}
    own = {w: int(model.head_class[i]) for w, i in place.items()}
    own.update({r.word.encode(): r["class"] for r in others.collect()})
    assert set(own) == set(counts) and set(own.values()) <= {0, 1}

    def history(word):
        i = place.get(word, 10**6)
        first = model.head.clustered
        return int(model.histories[i if i < first else first + class_lm.shape(word)])

    sizes, kinds, cells = Counter(), Counter(), np.zeros((2 + class_lm.SHAPES, 2))
    for word, n in counts.items():
        sizes[own[word]] += n
        kinds[own[word]] += 1
    for text in texts:
        words = [class_lm.END, *text.encode().split(), class_lm.END]
        for left, right in zip(words, words[1:]):
            cells[history(left), own[right]] += 1
    share = (cells + class_lm.SMOOTHING) / (cells.sum(axis=1, keepdims=True) + class_lm.SMOOTHING * 2)
    np.testing.assert_allclose(model.log_pairs, np.log10(share))

    def chance(left, word):
        if word in own:
            c = own[word]
            return share[history(left), c] * (counts[word] + 1) / (sizes[c] + kinds[c] + 1)
        return sum(share[history(left), c] / (sizes[c] + kinds[c] + 1) for c in (0, 1))

    for left in counts:
        # All words and one unseen word have all of the probability.
        assert sum(chance(left, w) for w in [*counts, b"unseen"]) == pytest.approx(1)
    asked = frame.union(spark.createDataFrame([(9, "new b new 77 h a")], frame.schema))
    texts.append("new b new 77 h a")
    for r in class_lm.score(asked, model, others).collect():
        words = [class_lm.END, *texts[min(r.id, 5)].encode().split(), class_lm.END]
        total = sum(math.log10(chance(x, y)) for x, y in zip(words, words[1:]))
        assert r.score == pytest.approx(total)


def test_whole_vocabulary_is_exchanged_by_exact_gains_in_any_layout(spark):
    rng = np.random.default_rng(4)
    histories, classes, words = 6, 3, 80
    likes = np.arange(words) % classes
    n = rng.poisson(np.where(np.arange(histories)[:, None] % classes == likes, 6, 0.3))
    n[:, 70:] = 0
    n[rng.integers(0, histories, 10), np.arange(70, 80)] = 1
    seeds = rng.poisson(np.where(np.arange(histories)[:, None] % classes == np.arange(classes), 40, 2)).astype(float)
    rows = [
        (f"w{w:02d}", -1, int(n[:, w].sum()), [(h, int(n[h, w])) for h in range(histories) if n[h, w]])
        for w in range(words)
    ]
    schema = "word string, place int, n long, near array<struct<history:int,n:long>>"
    frame = spark.createDataFrame(rows, schema)
    results = []
    for layout in (frame.coalesce(1), frame.repartition(5)):
        table, cells = class_exchange.exchange_vocabulary(layout, seeds, 2)
        results.append({r.word: r["class"] for r in table.collect()})
        check = seeds.copy()
        for word, own in results[-1].items():
            check[:, own] += n[:, int(word[1:])]
        np.testing.assert_allclose(cells, check)
    assert results[0] == results[1] and len(results[0]) == words
    assert np.mean([results[0][f"w{w:02d}"] == likes[w] for w in range(70)]) > 0.95
    # A chosen class is the best by the likelihood itself.
    for w in range(words):
        entries = np.flatnonzero(n[:, w])
        for own in (None, np.array([1])):
            base = seeds + (0 if own is None else n[:, [w]] * np.array([[0, 1, 0]]))
            free = base - (0 if own is None else n[:, [w]] * np.array([[0, 1, 0]]))
            found = class_exchange.best_classes(base, np.array([0]), entries, n[entries, w].astype(float), own)
            options = []
            for c in range(classes):
                trial = free.copy()
                trial[:, c] += n[:, w]
                options.append(class_exchange.cell_likelihood(trial))
            assert options[int(found[0])] == pytest.approx(max(options), abs=1e-6)


def test_exchange_gains_and_finds_planted_classes(spark):
    rng = np.random.default_rng(10)
    truth = np.arange(12) % 3
    rows = []
    for left in range(12):
        for right in range(12):
            rate = 200 if truth[right] == (truth[left] + 1) % 3 else 2
            rows.append((left, right, int(rng.poisson(rate))))
    bigrams = spark.createDataFrame(rows, "left int, right int, n long")
    state, pairs = class_lm.exchange(bigrams, 12, classes=3, rounds=12)
    start = np.zeros_like(pairs)
    np.add.at(start, (np.arange(12)[[r[0] for r in rows]] // 4, np.arange(12)[[r[1] for r in rows]] // 4), [r[2] for r in rows])
    assert class_lm.likelihood(pairs) >= class_lm.likelihood(start)
    assert pairs.sum() == sum(r[2] for r in rows)
    # best_class reports the class bigrams that the move really leads to.
    own = int(state[0])
    after, before = np.zeros(len(pairs)), np.zeros(len(pairs))
    itself = 0
    for a, b, n in rows:
        if a == b == 0:
            itself = n
        elif a == 0:
            after[state[b]] += n
        elif b == 0:
            before[state[a]] += n
    for wanted in (own, (own + 1) % 3):
        moved = state.copy()
        moved[0] = wanted
        direct = np.zeros_like(pairs)
        for a, b, n in rows:
            direct[moved[a], moved[b]] += n
        chosen, reported = class_lm.best_class(direct, 3, wanted, after, before, itself)
        again = moved.copy()
        again[0] = chosen
        check = np.zeros_like(pairs)
        for a, b, n in rows:
            check[again[a], again[b]] += n
        np.testing.assert_allclose(reported, check)
        options = []
        for c in range(3):
            trial = moved.copy()
            trial[0] = c
            t = np.zeros_like(pairs)
            for a, b, n in rows:
                t[trial[a], trial[b]] += n
            options.append(class_lm.likelihood(t))
        assert options[chosen] == pytest.approx(max(options))


def test_class_model_on_an_empty_table(spark, docs):
    assert class_lm.report(docs([])).count() == 0


def test_fit_takes_one_row_of_every_labelled_id(spark, docs, monkeypatch):
    taken = []
    monkeypatch.setattr(line_crf, "fit_field", lambda own, per, labels: taken.append((len(per), len(labels))))
    rows = [(1, f"line {i}\nmore {i}", "en", "s", 0) for i in range(200)] + [(2, "bad", "en", "s", 0), (3, "", "en", "s", 0)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    line_crf.train(docs(rows).repartition(4), labels, held_out=(1, 2))
    assert taken == [(2, 2)]


def test_exchange_ends_where_no_word_gains(spark):
    rng = np.random.default_rng(23)
    n = rng.poisson(rng.gamma(0.3, 8, (40, 40)))
    rows = [(a, b, int(n[a, b])) for a in range(40) for b in range(40) if n[a, b]]
    bigrams = spark.createDataFrame(rows, "left int, right int, n long").coalesce(2)
    state, pairs = class_lm.exchange(bigrams, 40, classes=4)
    for unit in range(40):
        others = np.arange(40) != unit
        after, before = np.zeros(len(pairs)), np.zeros(len(pairs))
        np.add.at(after, state[:40][others], n[unit, others])
        np.add.at(before, state[:40][others], n[others, unit])
        chosen, _ = class_lm.best_class(pairs, 4, int(state[unit]), after, before, float(n[unit, unit]))
        assert chosen == state[unit]


def test_very_long_words_are_walked_without_nodes():
    rng = random.Random(31)
    pieces = trie_tokens.zipf_scores(["a", "b", "ab", "aba", "bb", "é", "abab", "▁", "▁a", "babé"])
    trie, short = trie_tokens.Trie(pieces), trie_tokens.Trie(pieces, most_nodes=40)
    for n in (1, 7, 19, 20, 21, 200):
        word = "".join(rng.choice("abéx") for _ in range(n))
        assert short.insert(word) == trie.insert(word) == trie._walk(word)
        assert len(short.score) <= 41
    tracemalloc.start()
    trie = trie_tokens.Trie(pieces)
    trie.insert("ab" * 600_000)
    assert tracemalloc.get_traced_memory()[1] < 10_000_000 and len(trie.score) == 1
    tracemalloc.stop()


def test_words_are_read_by_place_or_shape():
    head = class_lm.Head({class_lm.END: 0, b"the": 1, b"of": 2}, np.array([4, 3, 2]), 2)
    reader = class_lm._Reader(head)
    text = "The of of 7x ends. word longer9 longish verylongword ٣"
    places, units, others = reader.read(text)
    words = [*class_lm.tokens(text), class_lm.END]
    want = [head.index[w] if head.index.get(w, 2) < 2 else 2 + class_lm.shape(w) for w in words]
    assert units.tolist() == want == reader.units_of(text).tolist()
    assert [w for w, p in zip(words, places) if p < 0] == others and len(others) == 7
    assert [head.index.get(w, -1) for w in words] == np.maximum(places, -1).tolist()
    assert len(reader.find.__self__) == 3
