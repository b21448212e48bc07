"""Collocations, conversation repair and repeated passages against plain versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import chunks, collocations, conversations, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_passages(rows, window=20):
    """doc -> (words, removed, digest) of rows (place, text) in order."""
    seen, found = set(), {}
    for name, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for start in range(len(words) - window + 1):
            passage = tuple(words[start : start + window])
            if passage in seen:
                gone[start : start + window] = [True] * window
            seen.add(passage)
        kept = [w for w, g in zip(words, gone) if not g]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        found[name] = (len(words), len(words) - len(kept), digest)
    return found


def passage_texts():
    draw = random.Random(4)
    fresh = lambda n: [f"w{draw.randrange(10**6)}é" for _ in range(n)]
    shared, line, head = fresh(75), fresh(12), fresh(30)
    texts = [" ".join(fresh(40)) for _ in range(5)] + [None, "", " \n\t", "one two"]
    for i in range(12):
        texts.append(" ".join(fresh(7 + i) + shared + fresh(5)))
        texts.append("\n".join(fresh(3 + i) + line + fresh(30)))
        texts.append("\t ".join(head[: 19 + i] + fresh(25) + shared[i : i + 20 + i]))
    whole = " ".join(fresh(60))
    texts += [whole] * 7 + [whole.replace(" ", "  ")] + [" ".join(whole.split()[:19])] * 3
    texts.append(" ".join(["again"] * 300))
    texts.append(" ".join(shared[:25] + shared[:25] + fresh(3) + shared[40:]))
    texts.append(" ".join(fresh(30_000) + shared))
    return texts


def test_passages_equal_brute_force(docs):
    texts = passage_texts()
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.report(docs(texts)).collect()}
    assert got == plain_passages(enumerate(texts))


def test_passage_spans_are_maximal_and_give_the_kept_text(docs):
    texts = passage_texts()
    for r in substring_dedup.repeats(docs(texts)).collect():
        words = WORD.findall(texts[r.id] or "")
        gone = set()
        for s in r.spans:
            assert s.words >= 20 and s.start - 1 not in gone and s.start not in gone
            gone |= set(range(s.start, s.start + s.words))
        assert len(gone) == r.removed
        assert r.kept == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_passages_of_missing_ids_ties_and_repeated_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(None, text, "a"), (7, text, "b"), (7, text, "c"), (7, text, "c"), (3, "x " + text, "d")]
    table = spark.createDataFrame(rows, "doc_id long, text string, chunk string")
    table = table.withColumnsRenamed({"chunk": "body"}).selectExpr("*", "1 AS tie", "2 AS place")
    got = sorted(
        ((r.doc_id is None, r.doc_id), r.n_removed) for r in substring_dedup.report(table).collect()
    )
    assert got == [((False, 3), 0), ((False, 7), 30), ((False, 7), 30), ((False, 7), 30), ((True, None), 30)]
    assert substring_dedup.report(table.limit(0)).collect() == []
    alone = substring_dedup.report(table.where("doc_id IS NULL").union(table.where("doc_id IS NULL")))
    assert [r.n_removed for r in alone.collect()] == [0, 0]  # rows that agree are one document


def test_windows_of_prefix_polynomials_depend_on_their_words_only():
    hashes = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x1234567)
    twice = np.concatenate([hashes, hashes])
    found = chunks.Prefixes(twice).windows(7)
    assert (found[: 199 - 6] == found[199:]).all()
    assert len(set(found[:199].tolist())) == 199
    assert len(chunks.Prefixes(hashes[:3]).windows(4)) == 0


def plain_phrases(rows, least, top):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    result = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = (
            a2
            for (lang2, longer), a2 in candidates.items()
            if lang2 == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        )
        if any(100 * a2 >= 100 * a for a2 in inside):
            continue
        score, k = min(
            (1000 * a * total[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k)
            for k in range(1, len(words))
        )
        phrase = " ".join(words)
        result[lang].append(
            (-score, -a, phrase.encode(), phrase, counts[lang, words[:k]], counts[lang, words[k:]])
        )
    return sorted(
        (lang, rank + 1, phrase, -a, left, right, total[lang], -score)
        for lang, found in result.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:top])
    )


def phrase_rows():
    draw = random.Random(5)
    names = ["The", "of", "Été", "data", "été", "x-y", "a", " b", "zé"]
    rows = [(None, None), ("en", ""), ("en", "  ... "), ("und", "a b a b a b")]
    for i in range(150):
        words = [draw.choice(names) for _ in range(draw.randrange(1, 60))]
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", ";"]) for w in words)
        rows.append((draw.choice(["en", "en", None, "fr"]), text + " in the north of data"))
    return rows + rows[20:40] * 2 + [("fr", "in the north of data " * 5000)]


def test_phrases_equal_brute_force(spark, monkeypatch):
    rows = phrase_rows()
    table = spark.createDataFrame(
        [(lang, text, 1, "x") for lang, text in rows], "lang string, text string, size int, phrase string"
    )
    for least, top in ((100, 2000), (3, 25)):
        monkeypatch.setattr(collocations, "LEAST", least)
        found = collocations.frequent_phrases(table, least=least)
        scored = collocations.not_held(collocations.scores(found))
        assert {(r.lang, r.phrase) for r in scored.collect()} == {
            (r[0], r[2]) for r in plain_phrases(rows, least, 10**9)
        }
        if least == 100:
            got = sorted(tuple(r) for r in collocations.report(table, top=top).collect())
            assert got == plain_phrases(rows, least, top)
    assert collocations.report(table.limit(0)).collect() == []


def test_colliding_fingerprints_are_told_apart_or_refused():
    rows = [("en", "a b c d e f g h " * 3), ("en", "b a d c " * 4)]
    words = collocations.Words("en", [(chunks.squeezed(collocations.lines(t)), 2) for _, t in rows])
    at, prints = words.prints(2)
    _, _, pointer, times = collocations._found(words, at, 2, prints * 0 + np.uint64(9))
    got = {" ".join(words.names[i].decode() for i in words.ids[p : p + 2]): n for p, n in zip(pointer, times)}
    want = collections.Counter()
    for _, text in rows:
        w = text.split()
        for pair in zip(w, w[1:]):
            want[" ".join(pair)] += 2
    assert got == want
    words.checks = chunks.Prefixes(np.zeros(len(words.ids), np.uint64))
    with pytest.raises(ValueError, match="share both"):
        collocations._found(words, at, 2, prints * 0 + np.uint64(9))


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**15 + 7, 9 * 10**17 + 11, 4 * 10**15 + 9, 5 * 10**15 + 3
    rows = [("en", 0, "", n), ("en", 1, "p", left), ("en", 1, "q", right), ("en", 2, "p q", a)]
    found = spark.createDataFrame(rows, collocations.FOUND)
    (r,) = collocations.scores(found).collect()
    assert r.score == 1000 * a * n // (left * right)


def plain_repair(rows):
    """Least (cost, audit) by a forward pass over all states."""
    after = {0: 2, 1: 2, 3: 2, 2: 3}

    def insert(states):
        for _ in range(4):
            for state, (cost, audit) in list(states.items()):
                new = (cost + 3, audit + "I")
                if new < states.get(after[state], (10**9,)):
                    states[after[state]] = new
        return states

    states = insert({0: (0, "")})
    for initial, must_go, truncated in rows:
        reached = {}

        def put(state, cost, audit):
            if (cost, audit) < reached.get(state, (10**9,)):
                reached[state] = (cost, audit)

        for state, (cost, audit) in states.items():
            put(state, cost + 4, audit + "D")
            if not must_go:
                more = 3 if truncated else 0
                if (initial, state) in (("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)):
                    put({"s": 1, "u": 2, "a": 3}[initial], cost + more, audit + "K")
                put(after[state], cost + 3 + more, audit + "R")
        states = insert(reached)
    return min(states[q] for q in (0, 3) if q in states)


def test_two_ended_search_finds_the_least_audit():
    kinds = [(c, g, t) for c in "suat" for g, t in ((False, False), (True, False), (False, True))]
    for size in (0, 1, 2):
        for rows in itertools.product(kinds, repeat=size):
            rows = list(rows)
            assert conversations.cheapest(rows, 0, (0, 3)) == plain_repair(rows)
    draw = random.Random(6)
    for _ in range(300):
        rows = [draw.choice(kinds) for _ in range(draw.randrange(3, 14))]
        assert conversations.cheapest(rows, 0, (0, 3)) == plain_repair(rows)


def plain_report(turns):
    held, names = collections.defaultdict(list), []
    spelled = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in turns:
        names.append(conv)
        fault = zlib.crc32(f"{spelled(conv)}:{spelled(turn)}".encode()) % 20
        role, text = spelled(role), spelled(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        held[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    found = {}
    for conv in names:
        rows = sorted(held[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, counts, lattice = set(), collections.Counter(), []
        for _, role, text in rows:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (
                "blank" if not shown else "duplicate" if (role, text) in seen
                else "" if shown[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
            counts[fault] += 1
            lattice.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(lattice, lattice[1:]))
        cost, audit = plain_repair(lattice) if rows else (0, "")
        lines, at, state = [], 0, 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            role, text = rows[at][1:] if letter in "KR" else ("", "")
            at += letter in "KR"
            state = {"s": 1, "u": 2, "a": 3}[role[0]] if letter == "K" else {0: 2, 1: 2, 2: 3, 3: 2}[state]
            lines.append((role if letter == "K" else "user" if state == 2 else "assistant") + ":" + text)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (
            gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest
        )
    return found


def turn_rows():
    draw = random.Random(7)
    texts = ["Yes.", "No", "", None, "  \n", "What is it?", "Well. ", "Fine!", "x" * 3000 + "."]
    rows = [(None, 0, "user", "Hi."), (None, None, None, None), (1, 0, "assistant", "Alone.")]
    for conv in range(2, 60):
        for turn in range(draw.randrange(1, 12)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, draw.choice([turn, turn, turn, None, turn // 2]), role, draw.choice(texts)))
    return rows


def test_conversations_equal_brute_force(spark):
    rows = turn_rows()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "1 AS conv", "2 AS part", "3 AS copy")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.report(table).collect()}
    assert got == plain_report(rows)
    assert conversations.report(table.limit(0)).collect() == []


def test_a_conversation_in_many_segments_and_tasks(spark, monkeypatch):
    draw = random.Random(8)
    monkeypatch.setattr(conversations, "SEGMENT", 5)
    rows = [
        (9, t, draw.choice(["user", "assistant", "system"]), draw.choice([f"{t}.", f"{t}", "", "Ok."]))
        for t in range(400)
    ] + [(c, t, "user", "Ok.") for c in (1, 20) for t in range(30)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = plain_report(rows)
    assert {r.conv_id: tuple(r)[1:] for r in conversations.report(table.repartition(7)).collect()} == want
    damaged = conversations.damaged(table)
    repair = conversations.Repair(damaged, "conv")
    turns = sorted(repair.turns().where("conv = 9").collect(), key=lambda r: (r.part, r.number))
    text = "\n".join(f"{r.role}:{r.text}" for r in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == want[9][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))
    assert "".join(r.edit for r in turns) == want[9][-2].replace("D", "")


@pytest.mark.parametrize("count", [1, 2, 400])
def test_repeated_rows_are_one_turn_and_its_duplicates(spark, count):
    rows = [(1, 0, "user", "Hi.")] * count + [(1, 1, "assistant", "Yes.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (total,) = conversations.Repair(table).totals.collect()
    assert (total.duplicate, total.cost, total.audit) == (count - 1, 4 * (count - 1), "K" + "D" * (count - 1) + "K")


def test_packed_counts_open_as_they_were_closed():
    prints = np.array([5, 5, 9, 1 << 40, 7], np.uint64)
    sent = dict(collocations._totals([prints], [np.array([1, 2, 1, 1, 1 << 33])], 3))
    found = collections.Counter()
    for payload in sent.values():
        for low, times in zip(*collocations._opened(payload)):
            found[int(low)] += int(times)
    assert found == {5: 3, 9: 1, 0: 1, 7: 1 << 33}
    assert chunks.letters(1, sent.items()).schema.equals(chunks.LETTER_ARROW)
    assert isinstance(chunks.answers(1, 0, []), pa.Table)
