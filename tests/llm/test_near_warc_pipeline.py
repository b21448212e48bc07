"""SimHash groups, WARC archives and the pipeline against plain versions."""

import base64
import gzip
import hashlib
import io
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from riskframe.llm import byte_bpe, line_crf, mixing, simhash, warc
from riskframe.llm.queries import ranks


def plain_fingerprint(text, size=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, prints, budget=3):
    root = list(range(len(ids)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= budget):
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return [least.get(top(i)) for i in range(len(ids))]


TEXTS = [None, "", " \t\n", "One", "one", "ONE two", "one  two\x0bthree", "É é É", "word " * 40000, "a\xa0b c d"]


def test_reports_match_the_plain_version(spark, docs):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = list(TEXTS)
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(30, 300))
        for _ in range(rng.randint(1, 5)):
            changed = list(base)
            for _ in range(rng.randint(0, 2)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            texts.append(" ".join(changed))
    rows = [(i if i % 17 else None, t, "en", "s", 0) for i, t in enumerate(texts, 1)] + [(5, texts[4], "en", "s", 0)]
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    want = plain_groups([k for k, *_ in rows], prints)
    found = simhash.report(docs(rows).repartition(4)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == Counter(
        (k, f"{p:016x}", g) for (k, *_), p, g in zip(rows, prints, want)
    )
    kept = simhash.representatives(docs(rows))
    groups = {(p, k): g for (k, *_), p, g in zip(rows, prints, want)}
    assert len({g for g in groups.values() if g is not None}) <= kept.count()


def test_every_pair_within_the_budget_is_linked(spark):
    rng = random.Random(12)
    prints = set()
    for _ in range(120):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(rng.randint(1, 4)):
            flips = rng.sample(range(64), rng.randint(1, 5))
            prints.add(base ^ sum(1 << b for b in flips))
    prints |= {0, 1, 2**63, 2**64 - 1, 7, 1 << 15 | 1 << 16 | 1 << 31}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(nodes).collect()}
    want = {
        (min(a, b), max(a, b))
        for a in signed for b in signed
        if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    }
    assert found == want


def test_groups_of_chains_stars_and_rings(spark):
    rng = random.Random(13)
    pairs, want = [], {}
    base = 0
    for shape in ("chain", "star", "ring"):
        nodes = list(range(base, base + 60))
        rng.shuffle(nodes)
        links = list(zip(nodes, nodes[1:]))
        if shape == "star":
            links = [(nodes[7], n) for n in nodes if n != nodes[7]]
        if shape == "ring":
            links.append((nodes[0], nodes[-1]))
        pairs += [(min(x), max(x)) for x in links]
        want.update({n: base for n in nodes})
        base += 100
    found = simhash.groups(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == want and len(found) == 180
    assert simhash.groups(spark.createDataFrame([], "a long, b long")).count() == 0


def test_representatives_keep_one_row_per_group(spark, docs):
    schema = "doc_id long, text string, fp string, tie int, root int, content string"
    rows = [(4, "same words here now", "x", 1, 1, "c"), (2, "SAME words here now", "y", 2, 2, "d")]
    rows += [(None, "same words here now", "z", 3, 3, "e"), (9, "else", "z", 3, 3, "e"), (9, "else", "z", 3, 3, "e")]
    rows += [(None, "lonely text", "q", 0, 0, "f")]
    kept = simhash.representatives(docs(rows, schema))
    assert kept.columns == schema.replace(",", "").split(" ")[::2]
    assert sorted((str(r.doc_id), r.fp) for r in kept.collect()) == [("2", "y"), ("9", "z"), ("None", "q")]
    assert simhash.representatives(docs([])).count() == 0 and simhash.report(docs([])).count() == 0


PAGE = "page_id long, url string, html string"


def plain_pages(rows):
    best = {}
    for page, _, html in rows:
        own = best.setdefault(html or "", page)
        if page is not None and (own is None or page > own):
            best[html or ""] = page
    first, out = set(), []
    for page, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if data in first:
            out.append((page, len(data), digest, "revisit", best[html or ""]))
        else:
            first.add(data)
            out.append((page, len(data), digest, "response", None))
    return Counter(out)


PAGES = [
    (1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://a/\r\nX-Bad: 1", ""),
    (5, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\n"), (6, "u", "\r\n\r\n"), (None, "n", "alone"), (7, "u", "x" * 300000),
    (8, "u", "twin"), (8, "u", "twin"), (8, "v", "twin"), (None, None, "<p>é</p>"), (9, "u", "\n\r\n"),
]


def test_archives_read_back_as_the_plain_version(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, PAGE).withColumn("record", F.lit(1)).withColumn("share", F.lit("s"))
    folder = str(tmp_path / "archive")
    warc.write_archives(pages.repartition(5), folder)
    found = warc.read_archives(spark, folder).collect()
    assert Counter(tuple(r) for r in found) == plain_pages(PAGES)


def test_archives_follow_the_format(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(PAGES, PAGE), str(tmp_path / "archive"))
    ids, payloads, seen = {}, {}, []
    for path in Path(tmp_path / "archive").glob("*.gz"):
        data = gzip.decompress(path.read_bytes())
        for headers, block in warc.parse_records(io.BytesIO(data)):
            assert headers["WARC-Record-ID"] not in ids
            ids[headers["WARC-Record-ID"]] = headers
            assert len(block) == int(headers["Content-Length"])
            seen.append(headers["WARC-Type"])
            if headers["WARC-Type"] == "response":
                head, _, body = block.partition(b"\r\n\r\n")
                assert head.startswith(b"HTTP/1.1 200") and body not in payloads
                payloads[body] = headers["WARC-Record-ID"]
    for headers in ids.values():
        assert "X-Bad" not in headers
        if headers["WARC-Type"] == "revisit":
            original = ids[headers["WARC-Refers-To"]]
            assert original["WARC-Type"] == "response"
            assert original["WARC-Payload-Digest"] == headers["WARC-Payload-Digest"]
    assert Counter(seen)["response"] == len({r[2] or "" for r in PAGES})


def test_small_payloads_are_not_shared_and_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, PAGE)
    warc.write_archives(pages, str(tmp_path / "a"), least_bytes=9)
    kinds = Counter((r.payload_bytes, r.record_type) for r in warc.read_archives(spark, str(tmp_path / "a")).collect())
    assert kinds[4, "response"] == 4 and kinds[9, "revisit"] == 2 and kinds[0, "response"] == 2
    path = next(p for p in Path(tmp_path / "a").glob("*.gz") if b"alone" in gzip.decompress(p.read_bytes()))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"alone", b"a1one")))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="payload differs"):
        warc.read_archives(spark, str(tmp_path / "a")).collect()


def test_files_of_many_gzip_members_are_read_whole(spark, tmp_path):
    pages = [(i, f"http://x/{i}", f"<p>page {i} {'long ' * 20000 * (i == 3)}</p>") for i in range(5)]
    warc.write_archives(spark.createDataFrame(pages, PAGE).coalesce(1), str(tmp_path / "a"))
    want = warc.read_archives(spark, str(tmp_path / "a")).orderBy("page_id").collect()
    (tmp_path / "b").mkdir()
    for n, path in enumerate(Path(tmp_path / "a").glob("*.gz")):
        text = gzip.decompress(path.read_bytes())
        starts = [m.start() for m in re.finditer(rb"WARC/1\.1\r\n", text)] + [len(text)]
        members = [gzip.compress(text[a:b]) for a, b in zip(starts, starts[1:])]
        (tmp_path / "b" / f"{n}{path.name[path.name.index('.'):]}").write_bytes(b"".join(members))
    assert warc.read_archives(spark, str(tmp_path / "b")).orderBy("page_id").collect() == want
    assert len(want) == 5


def test_an_empty_table_of_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGE), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stage_by_stage_against_plain_versions(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "simhash near-dedup", "source mixing", "byte-level bpe"]
    columns = documents.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    quality, dedup, near, mixed, tokens = [stage for _, stage in corpus_pipeline.STAGES]

    def held(df):
        assert df.columns == columns
        return df.sparkSession.createDataFrame(df.collect(), df.schema)

    good = held(quality(spark, documents, FOLDER))
    field = line_crf.train(documents, labels)
    rows = documents.collect()
    scores = [line_crf.document_scores(field, [r.text or ""])[0] for r in rows]
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r, s in zip(rows, scores) if s >= 0.7)

    once = held(dedup(spark, good, FOLDER))
    best = {}
    for r in good.collect():
        best[r.text or ""] = max(best.get(r.text or "", r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in once.collect()) == sorted(best.values())

    apart = held(near(spark, once, FOLDER))
    rows = once.collect()
    rows.sort(key=lambda r: r.doc_id)
    _, groups = plain_similar([r.text for r in rows])
    assert sorted(r.doc_id for r in apart.collect()) == sorted(rows[i].doc_id for i in set(groups))

    blend = held(mixed(spark, apart, FOLDER))
    plan = {r.doc_id: r.epochs + r.picked for r in mixing.mixing_plan(apart).collect()}
    assert Counter(r.doc_id for r in blend.collect()) == Counter(plan)

    last = tokens(spark, blend, FOLDER).collect()
    encoder = byte_bpe.Encoder(ranks(), public_tokenizers.PATTERN)
    assert len(last) == blend.count()
    for r in last:
        assert encoder.decode(bytes(r.token_ids)) == (r.text or "").encode()
        assert len(r.token_ids) == 4 * r.n_tokens


def test_run_gives_the_rows_of_its_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns[-2:] == ["n_tokens", "token_ids"] and 0 < found.count()


def test_stages_take_empty_tables_and_other_columns(spark, docs):
    for frame in (docs([]), docs([(None, None, None, None, None), (1, "", "en", "s", 0)])):
        wide = frame.withColumn("row", F.lit("r")).withColumn("content", F.lit(1)).withColumn("score", F.lit(2))
        for _, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, wide, FOLDER)
            assert out.columns == wide.columns and out.count() <= max(wide.count() * 3, 0)


def plain_similar(texts, size=5, similarity=0.8):
    """Pairs at or above the similarity, and every text's group, by brute force."""
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(texts)))
    pairs = [
        (i, j) for j in range(len(texts)) for i in range(j)
        if sets[i] == sets[j] or len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    ]
    for _ in texts:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return pairs, root


def test_stage_drops_all_copies_at_the_similarity(spark, docs, monkeypatch):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    texts = list(TEXTS)
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(60, 300))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            changed = list(base)
            for _ in range(rng.randint(1, 1 + len(base) // 45)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            texts.append(" ".join(changed))
    pairs, root = plain_similar(texts)
    prints = [plain_fingerprint(t) for t in texts]
    assert sum((prints[i] ^ prints[j]).bit_count() > 3 for i, j in pairs) > 20
    kept = corpus_pipeline.drop_near_copies(spark, docs(texts).repartition(4), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    # A large group is dealt into slots and stays one.
    monkeypatch.setattr(simhash, "MET", 8)
    base = rng.choices(words, k=400)
    copies = [" ".join([*base, f"end{i}"]) for i in range(60)]
    kept = corpus_pipeline.drop_near_copies(spark, docs([*copies, "lonely text"]), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 60]


def test_boilerplate_in_a_large_key_loses_no_link(spark, docs, monkeypatch):
    """Texts over one template at 0.78, every second one with a twin above 0.8."""
    monkeypatch.setattr(simhash, "MET", 16)
    rng = random.Random(23)
    fresh = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    template, texts = fresh(300), []
    for i in range(40):
        own = fresh(40)
        texts.append(" ".join(template + own))
        if i % 2:
            texts.append(" ".join(template + own[:20] + fresh(20)))
    pairs, root = plain_similar(texts)
    assert len(set(root)) == 40 and len(pairs) == 20
    kept = corpus_pipeline.drop_near_copies(spark, docs(texts), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_sets_open_as_they_were_closed():
    hashes = np.random.default_rng(24).integers(0, 1 << 63, 500, np.uint64)
    assert (simhash.opened_set(simhash.closed_set(hashes)) == np.unique(hashes >> np.uint64(24))).all()
    assert len(simhash.opened_set(simhash.closed_set(hashes[:0]))) == 0


def test_band_keys_follow_the_similarity():
    rng = np.random.default_rng(22)
    shared = 0
    for _ in range(200):
        both = rng.integers(0, 1 << 63, 160, np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, 20, np.uint64)]) for _ in range(2))
        shared += (simhash.band_keys(a) == simhash.band_keys(b)).sum()
    assert shared / (200 * simhash.BANDS) == pytest.approx(0.8**4, abs=0.05)


def test_segments_are_simhashes_of_the_shingles_dealt_to_them(monkeypatch):
    rng = np.random.default_rng(25)
    for size in (1, 2, 9, 40, 400):
        hashes = np.unique(rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1))
        step = simhash.steps(len(hashes), 0.8)[0]
        place, prints = simhash.segment_prints(hashes, step)
        with monkeypatch.context() as patch:
            # Alone, a shingle shows where it is dealt to.
            patch.setattr(simhash, "FEWEST", 1)
            dealt = {x: simhash.segment_prints(np.array([x], np.uint64), step)[0].tolist() for x in hashes.tolist()}
        want = {}
        for at in range(simhash.RING):
            own = [x for x, places in dealt.items() if at in places]
            if len(own) >= (simhash.FEWEST if len(hashes) >= simhash.LONG else 1):
                want[at] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))
        assert dict(zip(place.tolist(), prints.tolist())) == want


def test_runs_of_any_length_have_a_majority():
    hashes = np.random.default_rng(26).integers(0, 1 << 63, 700, np.uint64)
    starts = np.array([0, 1, 3, 40])
    counts = np.diff(np.append(starts, len(hashes)))
    found = simhash._majority(hashes, starts, counts).tolist()
    for got, start, n in zip(found, starts, counts):
        own = hashes[start : start + n].tolist()
        assert got == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > n)


def test_texts_at_the_similarity_share_a_segment():
    rng = np.random.default_rng(27)
    met = pairs = 0
    for size in (5, 9, 14, 22, 40, 90, 180, 360, 1500):
        for _ in range(40):
            draw = rng.integers(0, 1 << 63, 2 * size, np.uint64)
            both = int(np.ceil(1.6 * size / 1.8))
            a, b = draw[:size], np.concatenate([draw[:both], draw[size : 2 * size - both]])
            smaller = a[: int(np.ceil(0.8 * size))]
            for x, y in ((a, b), (a, smaller)):
                assert simhash.jaccard(np.sort(x), np.sort(y)) >= 0.8
                met += bool(np.intersect1d(simhash.segment_keys(x, 0.8), simhash.segment_keys(y, 0.8)).size)
                pairs += 1
    assert met == pairs
    far = [simhash.segment_keys(rng.integers(0, 1 << 63, 200, np.uint64), 0.8) for _ in range(50)]
    assert len(np.unique(np.concatenate(far))) == sum(map(len, far))
