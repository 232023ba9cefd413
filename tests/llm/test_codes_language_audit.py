"""Language ID, vector codes and the filter audit against brute force, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from conftest import SF

from riskloom.llm import audit, codes, language

DOCS = "bits string, doc_id long, text string, lang string, n int, key int, part string, id int, label int"


def rows_of(spark, rows):
    """(doc_id, text, lang) as documents with columns named as the operators name theirs."""
    return spark.createDataFrame([("b", *r, 1, 2, "p", 3, 4) for r in rows], DOCS)


# --- language -------------------------------------------------------------------------------------


def accepts(step, text):
    state = 0
    for byte in text:
        if byte not in step[state]:
            return False
        state = step[state][byte]
    return True


def test_automata_know_all_substrings_and_no_others():
    rng = random.Random(1)
    for _ in range(30):
        text = bytes(rng.choices(b"ab c", k=rng.randint(0, 25)))
        step = language.automaton(text)
        inside = {text[i:j] for i in range(len(text) + 1) for j in range(i, len(text) + 1)}
        assert all(accepts(step, s) for s in inside)
        for _ in range(50):
            probe = bytes(rng.choices(b"ab cd", k=rng.randint(0, 5)))
            assert accepts(step, probe) == (probe in inside)
        assert len(step) <= max(2, 2 * len(text))


def plain_phrases(text, reference, block):
    count = 0
    for start in range(0, len(text), block):
        lane = text[start : start + block]
        while lane:
            size = 1
            while size < len(lane) and lane[: size + 1] in reference and lane[:size] in reference:
                size += 1
            lane = lane[size:]
            count += 1
    return count


def test_phrases_equal_a_search_for_substrings(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 16)
    rng = random.Random(2)
    references = tuple(bytes(rng.choices(b"abc ", k=n)) for n in (40, 7, 1))
    texts = [bytes(rng.choices(b"abc xy", k=rng.randint(0, 70))) for _ in range(60)] + [b"", references[0]]
    found = language.Parser(references).phrases(texts)
    assert found.tolist() == [[plain_phrases(t, r, 16) for r in references] for t in texts]


def test_letters_are_words_between_single_spaces():
    assert language.letters("Été, 12 (x)\n\tÉ") == " été x é ".encode()
    assert language.letters("Éte") == " éte".encode() + b" "
    assert language.letters("12 _ $ ²") == language.letters("") == b""


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = language.train(docs)
    said = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    rows = docs.collect()
    unseen = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in unseen} == {d for d, r in said.items() if r["held_out"]}
    assert sum(said[r["doc_id"]]["lang_pred"] == r["lang"] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in said.values())
    # Labels of the held-out fold do not change anything.
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    assert language.train(other).references == model.references


def test_languages_of_odd_rows(spark):
    learnt = [(4 * i, t, lang) for i in range(40) for t, lang in (("the one and the other", "a"), ("el uno y el otro", "b"))]
    odd = [(None, "the other one", "a"), (1000, None, "a"), (1001, "", "b"), (1002, "12 % 3", None), (1003, "otro " * 60_000, None)]
    docs = rows_of(spark, learnt + odd + odd[-1:]).repartition(3)
    said = language.predict(docs, language.train(docs)).collect()
    assert len(said) == len(learnt) + 6
    by = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in said if r["doc_id"] is None or r["doc_id"] >= 1000}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(1000, 1004)}
    assert by == {None: ("a", False), 1000: ("und", held[1000]), 1001: ("und", held[1001]), 1002: ("und", held[1002]), 1003: ("b", held[1003])}
    nothing = language.train(docs.where("lang IS NULL"))
    assert {(r["lang_pred"], r["score"]) for r in language.predict(docs, nothing).collect()} == {("und", 0.0)}
    assert language.predict(docs.limit(0), nothing).collect() == []


def test_ties_go_to_the_first_language():
    model = language.Model({"b": b" one ", "a": b" one ", "c": b""})
    names, score = model.predict(["one", "zzz"])
    assert names == ["a", "a"] and score.tolist() == [0.5, 0.5]


# --- codes ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "width", "top"), [(1, 3, 5), (3, 1, 2), (16, 8, 3), (60, 2, 4), (200, 8, 10**6), (40, 8, 2**27)])
def test_trees_find_the_nearest_of_lowest_index(n, width, top):
    rng = np.random.default_rng(n)
    points = rng.integers(-top, top + 1, (n, width))
    points[n // 2 :: 3] = points[0]
    queries = np.concatenate([points, rng.integers(-top, top + 1, (300, width))])
    index, best = codes.Gnat(points).nearest(queries)
    distance = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    assert index.tolist() == distance.argmin(axis=1).tolist()
    assert best.tolist() == distance.min(axis=1).tolist()


def test_trees_leave_out_subtrees():
    rng = np.random.default_rng(4)
    centres = rng.integers(-1000, 1000, (8, 4)) * 1000
    points = (centres[:, None] + rng.integers(-50, 50, (8, 32, 4))).reshape(-1, 4)
    tree = codes.Gnat(points)
    tree.nearest(points)
    assert tree.visited < len(points) ** 2 / 3


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    if not rows:
        return [], None
    fill = -len(rows[0][1]) % parts
    x = np.array([[math.floor(scale * v) for v in r[1]] + [0] * fill for r in rows], object)
    x = x.reshape(len(rows), parts, -1)
    books = [[list(x[i, p]) for i in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(p, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for q in x[:, p]:
                groups.setdefault(nearest(p, q)[1], []).append(q)
            for i, group in groups.items():
                books[p][i] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    found = [[nearest(p, q) for p, q in enumerate(row)] for row in x]
    error = [sum(d for d, _ in f) for f in found]
    label = {}
    for r, e in zip(rows, error, strict=True):
        label[r[2]] = label.get(r[2], 0) + e
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return sorted(
        (repr(r[0]), "".join(f"{i:02x}" for _, i in f), e, label[r[2]]) for r, f, e in zip(rows, found, error, strict=True)
    ), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("n", "size"), [(70, 16), (5, 8), (30, 11), (1, 3)])
def test_codes_equal_plain_rounds(spark, n, size):
    rng = random.Random(n)
    rows = [(i, [round(rng.gauss(0, 1), 3) for _ in range(size)], rng.choice([0, 1, None])) for i in range(0, 2 * n, 2)]
    rows += [rows[0], (None, rows[-1][1], 1), (0, rows[0][1], None)]
    rows += [(101, None, 1), (102, [0.5, None], 1), (103, [math.nan] * size, 0), (104, [math.inf] * size, 0), (105, [], 0), (106, [1.0], 1)]
    given = spark.createDataFrame(
        [("c", i, v, k, "x", 7, 1) for i, v, k in rows], "code string, vec_id long, embedding array<float>, label int, x string, error int, id int"
    ).repartition(3)
    floats = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], k) for i, v, k in rows]
    expected, digest = plain_codes(floats)
    found = codes.compress(given).collect()
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in found) == expected
    assert {r["codebooks_sha256"] for r in found} == {digest}


def test_codes_of_nothing_and_of_huge_numbers(spark):
    kind = "vec_id long, embedding array<double>, label int"
    nothing = codes.compress(spark.createDataFrame([(1, None, 1), (2, [math.nan], 2)], kind))
    assert nothing.collect() == []
    assert nothing.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    huge = codes.compress(spark.createDataFrame([(i, [(-1.0) ** i * 1e300] * 8, 1) for i in range(40)], kind)).collect()
    assert {r["error"] for r in huge} == {0} and len({r["code"] for r in huge}) == 2


# --- audit ----------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    smallest = {}
    for d, text, _ in docs:
        if d is not None:
            smallest[text or ""] = min(d, smallest.get(text or "", d))
    failing = []
    for d, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": d is not None and d > smallest[text],
        }
        failing.append((lang or "", {f for f, failed in fails.items() if failed}, d in good, d in toxic))
    rows, shapley = [], {}
    for part in {f[0] for f in failing}:
        own = [f for f in failing if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                earlier = [f for f in own if name in f[1] and f[1] & set(order[: step - 1])]
                left = [f for f in left if name not in f[1]]
                only = sum(f[1] == {name} for f in own)
                shapley[part, name] = shapley.get((part, name), 0) + len(gone)
                rows.append((part, order, step, len(left), len(gone), len(earlier), only, sum(f[2] for f in gone), sum(f[3] for f in gone), name))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in rows)


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_audit_equals_plain_counts(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["alpha", "Beta", "GAMMA", "d$", "e%", "ff", "g h", "É"], k=n)) for n in (3, 120, 120, 400)]
    texts += [" ".join(f"w{i}" for i in range(150)), " ".join(f"W{i}" for i in range(100)), "", None, "\t \n", "#" * 5, "word " * 40_000]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(90)]
    docs += [(None, texts[0], "en"), (None, texts[4], "xx"), (None, "alone", None), docs[3], docs[3], (docs[3][0], docs[3][1], "zz"), (5, "other", "en")]
    labels = [(rng.randrange(100), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)] + [(None, 1, 1)]
    said = spark.createDataFrame([(*r, "t", 1) for r in labels], "doc_id long, quality int, toxic int, text string, good int")
    found = audit.audit(rows_of(spark, docs).repartition(3), said).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found) == plain_audit(docs, labels)


def test_audit_writes_one_id_table_per_filter_and_takes_empty_tables(spark):
    docs = rows_of(spark, [(1, "a # b", "en"), (2, "a # b", "en"), (3, "w " * 200, None)])
    failing = audit.id_tables(audit.measured(docs, "doc_id", "text", "lang"))
    assert sorted((r["filter"], r["id"]) for r in failing.collect()) == [
        ("A", 1), ("A", 2), ("B", 3), ("D", 1), ("D", 2), ("E", 2)
    ]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).count() == 2 * 600
    assert audit.audit(docs.limit(0), labels).collect() == []
