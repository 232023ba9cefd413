"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import (
    chat, components, decontam, fingerprints, lines, minhash, packing, quality, rules, secrets, suffixes, urls,
)
from riskloom.llm.common import documents
from riskloom.llm.queries import tokenizer

SYLLABLES = "the of an er in ti on th es nd ea re ha or sh wh".split()
SCHEMA = "id string, text string, doc_id long, text_hash string, n int, spans string, key int"


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Prose with exact and near copies, shared passages, periodic, empty and null texts."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(3, 120)) for _ in range(20)]
    near = []
    for text in base[:6]:
        for _ in range(5):
            words = text.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = "changed" + str(rng.randrange(99))
            near.append(" ".join(words))
    passage = prose(rng, 60) + "."
    shared = [f"{prose(rng, 20)}. {passage} {prose(rng, 15)}" for _ in range(4)]
    odd = ["", None, " \n\t ", "one", "two words", "ab " * 300, "x" * 900, "é" * 300 + " ü", "the " * 30_000, base[0], base[0]]
    return base + near + shared + odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The texts with ids (one missing, one twice) and columns named as the operators name theirs."""
    rows = [("a", t, i, "b", 1, "c", 2) for i, t in enumerate(texts)]
    rows += [("a", texts[1], None, "b", 1, "c", 2), ("a", texts[2], 2, "b", 1, "c", 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


# --- chat -----------------------------------------------------------------------------------------


def messages(spark, rows):
    return spark.createDataFrame(
        rows, "tree_id long, node_id long, parent_id long, role string, text string, score double"
    )


def test_best_paths_equal_a_walk(spark):
    rng = random.Random(3)
    rows = []
    for node in range(120):
        tree = node % 3
        older = [r[1] for r in rows if r[0] == tree]
        rows.append((tree, node, rng.choice(older) if older else None, "user", str(node), float(rng.randint(0, 4))))
    parent, score = {r[1]: r[2] for r in rows}, {r[1]: r[5] for r in rows}

    def path(node):
        return [node] if parent[node] is None else [*path(parent[node]), node]

    leaves = set(parent) - set(parent.values())
    expected = set()
    for tree in range(3):
        ranked = sorted(
            (n for n in leaves if n % 3 == tree), key=lambda n: (-sum(score[k] for k in path(n)) / len(path(n)), n)
        )
        for leaf in ranked[:2]:
            expected |= {(leaf, tree, i, n) for i, n in enumerate(path(leaf))}
    assert {tuple(r) for r in chat.best_paths(messages(spark, rows), 2).collect()} == expected


def test_cycles_orphans_and_empty_trees(spark):
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0), (1, 3, 99, "tool", None, None)]
    assert [r["node_id"] for r in chat.best_paths(messages(spark, rows)).collect()] == [3]
    assert chat.best_paths(messages(spark, [])).collect() == []


def test_templates_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "\\</s>", "a\\", "[ROLE]x[/ROLE]", "", None, "[[INST]<<s>", "\n é \\\\[ANS]"]
    roles = ["user", "assistant", "system", "[INST]", None, "tool</s>"]
    turns = [(c, t, r, x) for c, x in enumerate(texts) for t, r in enumerate(roles)]
    given = spark.createDataFrame([*turns, (99, 0, "user", "b"), (99, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(chat.from_turns(given))
    read = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    whole = {r["tree_id"]: r["text"] for r in chat.whole_conversations(formatted).collect()}
    for c, x in enumerate(texts):
        expected = "".join(f"{r or ''}\n{x or ''}\n" for r in roles)
        assert read[c]["turns_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
        assert read[c]["loss_sha256"] == hashlib.sha256((x or "").encode()).hexdigest()
        assert read[c]["loss_chars"] == len(x or "") and read[c]["n_turns"] == len(roles)
        assert read[c]["formatted_chars"] == len(whole[c])
    assert read[99]["n_turns"] == 2
    assert chat.read_back(chat.format_conversations(chat.from_turns(given.limit(0)))).collect() == []


# --- quality --------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        text = prose(rng, rng.randint(20, 80))
        rows.append((i, text.upper().replace(" ", "!! ") if i % 4 == 0 else text, int(i % 4 != 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(frame.select("doc_id", "text"), frame.select("doc_id", "quality"), max_train=300)
    scored = quality.score(frame, model).join(frame, "doc_id").collect()
    assert {r["doc_id"] for r in scored if r["held_out"]} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == r["quality"] for r in scored if r["held_out"])


def test_pairs_learn_what_features_alone_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, n_pairs=1)
    assert model.pairs == [(0, 1)]
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95


def test_quality_without_labels_and_rows(spark, docs, empty):
    no_labels = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality.train(docs, no_labels)
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(empty, model).collect() == []
    assert quality.accepted(docs, model).columns == docs.columns


# --- secrets --------------------------------------------------------------------------------------


def test_base_spans_follow_the_fixed_patterns(spark):
    rng = random.Random(2)
    parts = ["password", "Token", "API_KEY", "apikey", '"', "'", " ", "=", ":", "AKIA", "ABCDEF0123456789XY", "0123456789abcdef" * 2,
             "x", "\n", "é", "secret", "=hunter2", "short"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(300)] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for row in secrets.scan(frame).collect():
        text = texts[row["doc_id"]] or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(
            sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")
        )
        assert {s for s in joined.split(",") if s} <= set(row["spans"].split(","))


def test_constants_propagate_and_plain_assignments_stay():
    text = 'PART = "Zx9qLm2";\ndb_password = PART + "tail99X"\ncolor = "Zx9qLm2aaa"\npassword = "changeme"'
    found = [text[s:e] for kind, s, e in secrets.all_spans(text)[1] if kind == "literal"]
    assert found == ["Zx9qLm2", "tail99X"]
    assert secrets.redact("nothing: here") == "nothing: here"


def copied_out(text):
    """The spans of sensitive literals with every constant's value copied where it is used."""
    constants, found = {}, set()
    for line in text.splitlines(keepends=True):
        start = text.index(line) if text.count(line) == 1 else None
        assert start is not None
        name, expression = line.split(" = ", 1)
        at, value, spans = start + len(name) + 3, "", []
        for term in expression.rstrip("\n").split(" + "):
            if term.startswith('"'):
                value, spans = value + term[1:-1], [*spans, (at + 1, at + len(term) - 1)]
            elif term in constants:
                value, spans = value + constants[term][0], spans + constants[term][1]
            elif spans:
                break
            else:
                value, spans = term, [(at, at + len(term))]
            at += len(term) + 3
        constants[name] = value, spans
        literal = secrets.Joined(value)
        if secrets.name_score(name) * secrets.literal_score(literal) >= secrets.MIN_SCORE:
            found |= {s for s in spans if s[1] > s[0]}
    return found


def test_shared_constants_equal_copied_ones():
    rng = random.Random(12)
    names = ["a", "b", "token", "db_password", "c_key", "color"]
    for _ in range(200):
        lines = []
        for i in range(rng.randint(1, 9)):
            terms = [
                rng.choice(names) if rng.random() < 0.5 else f'"{rng.choice(["Zx9q", "Lm2", "xxx", "", "a b"])}{i}"'
                for _ in range(rng.randint(1, 3))
            ]
            lines.append(f"{rng.choice(names)} = {' + '.join(terms)}\n")
        text = "".join(dict.fromkeys(lines))
        if len(set(lines)) == len(lines) and all(text.count(line) == 1 for line in lines):
            found = {(s, e) for kind, s, e in secrets.all_spans(text)[1] if kind == "literal"}
            assert found == copied_out(text), text


FORMS = [
    '{n} = "{v}"', "{n}: '{v}',", '"{n}": "{v}",', "export {n}={v}", "{n} := `{v}`", '{n} = """{v}"""', "{n} = '''{v}'''",
    '{n} = "{a}" +\n  "{b}"', '{n} = \\\n  "{v}"', '{n}:\n  "{v}"', "{n}: >-\n  {v}", "<{n}>{v}</{n}>", '<{n} x="y">\t{v} </{n}>',
    'part{i} = "{a}"\n{n} = "${{part{i}}}{b}"', "part{i}={v}\nexport {n}=$part{i}", "part{i}={v}\n{n}=${{part{i}}}",
]


def literals(text):
    return [text[s:e] for kind, s, e in secrets.all_spans(text)[1] if kind == "literal"]


def test_planted_secrets_are_found_in_every_form():
    """Recall and precision of the lexed layer on planted names, each in a line of its own among harmless ones."""
    rng = random.Random(6)
    sensitive = ["db_password", "API_SECRET", "authToken", "client_secret", "apiKey", "passphrase", "signing_key"]
    harmless = ["color", "buildNumber", "secretName", "token_file", "title", "password_length", "region"]
    planted, found = Counter(), Counter()
    for i in range(900):
        secret = "".join(rng.choices("abcdefghkmnpqrstwxyzABCDEFGH", k=9)) + "".join(rng.choices("23456789", k=5)) + "Zq"
        form = FORMS[i % len(FORMS)]
        is_secret = rng.random() < 0.5
        name = rng.choice(sensitive if is_secret else harmless)
        line = form.format(n=name, v=secret, a=secret[:6], b=secret[6:], i=i)
        if not is_secret and rng.random() < 0.3:
            line = f"{rng.choice(sensitive)} = {rng.choice(['"${UNKNOWN_NAME}"', '$OTHER_NAME', '"changeme"', 'get_it(4)', '""'])}"
        text = f"{prose(rng, 5)}.\n{line}\n{prose(rng, 4)}\n"
        planted[secret] += is_secret
        found["right" if is_secret and "".join(literals(text)) == secret else "wrong" if literals(text) else "none"] += 1
    wanted = sum(planted.values())
    assert found["right"] >= 0.99 * wanted, found
    assert found["right"] >= 0.99 * (found["right"] + found["wrong"]), found


def test_lexing_is_linear_on_unclosed_forms():
    import time

    began = time.process_time()
    for text in ('a = """ ', "a = `", "<a ", "<a>b ", "a=${", "a =\n", "x='''", "a = b +\n"):
        secrets.all_spans("token = x\n" + text * 100_000 + "</")
    secrets.all_spans('a="' + "${x" * 100_000 + '"')
    assert time.process_time() - began < 20


def test_constants_of_themselves_cost_a_line_each():
    import time

    doubled = 'token = "Zx9qLm2tail"\n' + "token = token + token\n" * 10_000
    chained = 'secret0 = "Zx9qLm2tail"\n' + "".join(f'secret{i + 1} = secret{i} + "p{i}"\n' for i in range(5_000))
    began = time.process_time()
    assert [s for s in secrets.all_spans(doubled)[1] if s[0] == "literal"] == [("literal", 9, 20)]
    assert sum(s[0] == "literal" for s in secrets.all_spans(chained)[1]) == 5_001
    assert time.process_time() - began < 10


def test_redaction_keeps_rows_and_nulls(docs, empty):
    assert secrets.redacted(docs).count() == docs.count()
    assert secrets.redacted(docs).where("text IS NULL").count() == 1
    assert secrets.scan(empty).collect() == []


# --- lines ----------------------------------------------------------------------------------------


def run_keys(text):
    """First and last unit and the units of each shortest run of a text, and the units."""
    there = [u for u in lines.units(text) if u[2]]
    counts = [len(u[2]) for u in there]
    spans = set()
    for i in range(len(there)):
        ends = [j for j in range(i, len(there)) if sum(counts[i : j + 1]) >= lines.MIN_WORDS]
        starts = [j for j in range(i + 1) if sum(counts[j : i + 1]) >= lines.MIN_WORDS]
        spans |= {(i, ends[0])} if ends else set()
        spans |= {(starts[-1], i)} if starts else set()
    return [(i, j, tuple(" ".join(u[2]) for u in there[i : j + 1])) for i, j in sorted(spans)], there


def without_repeats(rows):
    """The kept text of each (rank, text) of distinct documents, and how many units went, by plain search."""
    first = {}
    for rank, text in rows:
        for _, _, run in run_keys(text)[0]:
            first[run] = min(first.get(run, rank), rank)
    shared = Counter(run for rank, text in rows for run in {r for _, _, r in run_keys(text)[0]})
    answers = []
    for rank, text in rows:
        every, there = run_keys(text)
        gone, stays, seen = set(), set(), {}
        for i, j, run in every:
            at = seen.setdefault(run, (i, j))
            place = set(range(there[i][0], there[j][1]))
            if at[1] < i:
                gone |= place
                if first[run] == rank:
                    stays |= set(range(there[at[0]][0], there[at[1]][1]))
            elif first[run] < rank:
                gone |= place
            elif shared[run] > 1:
                stays |= place
        units = sum(there[i][0] in gone - stays for i in range(len(there)))
        answers.append(("".join(c for k, c in enumerate(text) if k not in gone - stays), units))
    return answers


def test_units_later_than_the_first_go(docs, empty):
    rows = sorted(
        {
            ((2**63 - 1, r["text_hash"]) if r["id"] is None else (r["id"], 0), r["text"])
            for r in documents(docs).collect()
        }
    )
    ids = {}
    for rank, text in rows:
        for _, _, words in lines.units(text):
            if len(words) >= lines.MIN_WORDS:
                ids.setdefault(" ".join(words), rank)
    texts, expected = Counter(plain(docs)), Counter()
    for rank, text in rows:
        seen, kept = set(), ""
        for start, end, words in lines.units(text):
            unit = " ".join(words)
            gone = len(words) >= lines.MIN_WORDS and (rank > ids[unit] or unit in seen)
            seen.add(unit)
            kept += "" if gone else text[start:end]
        doc_id = None if rank[0] == 2**63 - 1 else rank[0]
        expected[doc_id, kept] += texts[doc_id, text]
    found = lines.dedup(docs).collect()
    assert Counter((r["doc_id"], r["kept_text"]) for r in found) == expected
    assert sum(r["n_removed"] for r in found) > 0
    assert lines.dedup(empty).collect() == []
    assert lines.dedup(docs, unit="paragraph").count() == docs.count()


def test_repeated_runs_of_short_sentences_go(spark):
    rng = random.Random(3)
    short = [f"{prose(rng, k)}." for k in (1, 2, 3, 3, 4, 5, 7, 9)]
    line = "Yes it is. No it is not. We see. Ask us."
    passage = " ".join(f"{prose(rng, 4)}." for _ in range(15))
    rows = [f"{prose(rng, 12)}\n{line}\n{prose(rng, 9)}. {passage} {prose(rng, 12)}\n" for _ in range(12)]
    for _ in range(60):
        rows.append("".join(rng.choice(short) + rng.choice("  \n") for _ in range(rng.randint(1, 14))))
    rows += ["A b. " * 9, "A b. " * 4 + "\n\n" + "A b.", "Thank you.", "Thank you."]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    found = sorted(lines.dedup(docs).collect(), key=lambda r: r["doc_id"])
    assert [(r["kept_text"], r["n_removed"]) for r in found] == without_repeats(list(enumerate(rows)))
    assert line in found[0]["kept_text"] and passage in found[0]["kept_text"]
    for r in found[1:12]:
        assert line not in r["kept_text"] and not any(s in r["kept_text"] for s in re.findall(r"[^.]+\.", passage))


def test_what_repeats_still_stands_once(spark):
    a, b, c = "One two three four. ", "Five six seven eight. ", "Nine ten eleven twelve. "
    rng = random.Random(8)
    parts = [f"{prose(rng, k)}. " for k in (1, 2, 3, 4, 4, 5, 6, 8, 11)]
    rows = [a + b, a + b + c, b + c]
    rows += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"]: r["kept_text"] for r in lines.dedup(docs).collect()}
    assert [kept[k] for k in range(3)] == [a + b, b + c, ""]
    copies, standing = Counter(), set()
    for text in rows:
        copies.update({run for _, _, run in run_keys(text)[0]})
    for text in kept.values():
        written = [" ".join(u[2]) for u in lines.units(text) if u[2]]
        standing |= {tuple(written[i:j]) for i in range(len(written)) for j in range(i + 1, len(written) + 1)}
    repeated = {run for run, n in copies.items() if n > 1}
    assert len(repeated) > 50 and repeated <= standing


def test_documents_without_id_keep_one_occurrence(spark):
    line = "This line of nine words stands in every text."
    docs = spark.createDataFrame([(None, f"{line}\n{k}") for k in "abc"], "doc_id long, text string")
    found = lines.dedup(docs).collect()
    assert sorted(r["n_removed"] for r in found) == [0, 1, 1]
    named = lines.dedup(docs.unionByName(spark.createDataFrame([(7, line)], "doc_id long, text string"))).collect()
    assert [r["n_removed"] for r in named if r["doc_id"] == 7] == [0]
    assert sorted(r["n_removed"] for r in named) == [0, 1, 1, 1]


def test_clearing_spans():
    assert lines.cleared([(0, 4), (4, 9), (12, 20)], [(3, 5), (8, 13), (15, 16)]) == [(0, 3), (5, 8), (13, 15), (16, 20)]
    assert lines.cleared([(2, 3)], [(0, 9)]) == [] and lines.cleared([], [(0, 9)]) == []


def test_offsets_point_into_the_original(docs):
    texts = dict(plain(docs))
    for row in lines.dedup(docs).where("doc_id <> 2").collect():
        text, at, kept = texts[row["doc_id"]], 0, ""
        for span in filter(None, row["spans"].split(",")):
            start, end = map(int, span.split(":"))
            kept, at = kept + text[at:start], end
        assert kept + text[at:] == row["kept_text"]


# --- packing --------------------------------------------------------------------------------------


def test_pieces_equal_the_tokenizer(docs, empty):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer())
    texts = plain(docs)
    expected = Counter()
    for doc_id, text in texts:
        ids = np.array([*reference.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            expected[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r) for r in packing.pieces(docs, tokenizer(), 256).collect()) == expected
    assert packing.pack(packing.pieces(empty, tokenizer())).collect() == []


@pytest.mark.parametrize("text", ["It's A Test's 3rd—“x”", "ÀÉ İstanbul ΣΑΣ", "a\u0301b e\u0301.", "<|endoftext|> <|ENDOFTEXT|>", "x,y;z!! ?? a|b #1 ...", "tab\there\r\n\x0b\x1c\xa0end", "don't. can'T! l'été, naïve…"])
def test_word_ids_equal_the_tokenizer(text):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer())
    words = packing.WordIds(reference)
    assert np.frombuffer(words.of(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_sequences_are_gapless_and_few(spark):
    rng = random.Random(4)
    sizes = [rng.choice([4096, rng.randint(1, 4095), rng.randint(1200, 1500)]) for _ in range(900)]
    parts = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long")
    rows = packing.pack(parts, shard=400).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in by.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 4096
    assert sorted(r["doc_id"] for r in rows) == list(range(900))
    assert len(by) <= 1.03 * -(-sum(sizes) // 4096) + 3


def test_local_search_empties_a_bin():
    lengths = np.array([6, 3, 5, 4, 3, 3])
    start = [[0, 1], [2, 3], [4], [5]]
    found = packing.local_search(start, lengths, 12)
    assert sorted(i for b in found for i in b) == list(range(6))
    assert len(found) < len(start) and all(lengths[b].sum() <= 12 for b in found)


def test_local_search_looks_at_all_bins_and_pairs():
    # Only an exchange for two of 70 pieces empties the last bin.
    lengths = np.array([10] * 68 + [100, 100, 800, 300])
    assert len(packing.local_search([[*range(70)], [70], [71]], lengths, 1000)) == 2
    # The emptiest bin cannot be emptied, the next ones can.
    rng = random.Random(2)
    lengths = np.array([rng.randint(1200, 1500) for _ in range(300)])
    start = packing.best_fit(lengths, 4096)
    found = packing.local_search(start, lengths, 4096)
    assert sorted(i for b in found for i in b) == list(range(300)) and all(lengths[b].sum() <= 4096 for b in found)
    assert len(found) <= 0.96 * len(start)


def test_fewest_bins_are_not_overstated():
    rng = random.Random(6)
    for _ in range(60):
        lengths = [rng.randint(1, 12) for _ in range(7)]

        def fewest(rest, rooms):
            if not rest:
                return len(rooms)
            tried = [fewest(rest[1:], rooms[:k] + [r - rest[0]] + rooms[k + 1 :]) for k, r in enumerate(rooms) if r >= rest[0]]
            return min([*tried, fewest(rest[1:], [*rooms, 12 - rest[0]])])

        assert -(-sum(lengths) // 12) <= packing.least_bins(np.array(lengths), 12) <= fewest(lengths, [])


# --- near duplicates ------------------------------------------------------------------------------


def shingle_set(text, size):
    words = text.encode().lower().split()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


@pytest.mark.parametrize("block", [minhash.BLOCK, 150])
def test_components_equal_all_pairs(docs, monkeypatch, block):
    monkeypatch.setattr(minhash.verified, "__defaults__", (block,))
    rows = [(d, shingle_set(t, 3)) for d, t in plain(docs)]
    union = minhash.Union()
    for _ in rows:
        union.add()
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                union.join(i, j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(union.find(i), []).append(d)
    expected = Counter()
    for i, (d, s) in enumerate(rows):
        known = [x for x in groups[union.find(i)] if x is not None]
        smallest = min(known) if known else None
        expected[d, len(s), smallest, d == smallest] += 1
    found = minhash.near_duplicates(docs, 3, 85, 48).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found) == expected


def test_near_duplicates_of_nothing(empty):
    assert minhash.near_duplicates(empty).collect() == []


def test_minimum_and_maximum_are_unbiased():
    rng = np.random.default_rng(3)
    shared, own = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, (2, 100)).astype(np.uint64)
    a, b = (minhash.signature(np.concatenate([shared, o]), 512) for o in own)
    assert abs((a == b).mean() - 0.75) < 0.04
    assert abs((a[:512] == b[:512]).mean() - (a[512:] == b[512:]).mean()) < 0.08


def test_sets_and_signatures_of_many_texts_equal_those_of_each():
    rng = random.Random(8)
    texts = ["", " \n\t", "a", "A b", "ä Ö", "x\x0by\x0cz\x1cw v", " lead", "trail ", "long" * 9000 + " b c d"]
    texts += [" ".join(rng.choices("abcDEF", k=rng.randint(0, 60))) for _ in range(200)]
    for size in (1, 3, 5):
        values, count = minhash.shingle_sets([t.encode() for t in texts], size)
        sets = np.split(values, np.cumsum(count)[:-1])
        assert [len(s) for s in sets] == [len(shingle_set(t, size)) for t in texts]
        assert all((np.diff(s) > 0).all() and (s == minhash.shingles(t, size)).all() for s, t in zip(sets, texts, strict=True))
        # Equal shingles, and only these, have equal hashes.
        plain_sets = [shingle_set(t, size) for t in texts]
        for i in range(9, 60):
            assert len(np.intersect1d(sets[i], sets[i + 1])) == len(plain_sets[i] & plain_sets[i + 1])
        filled = [s for s in sets if len(s)]
        sigs = minhash.signatures(values, np.cumsum(count)[count > 0] - count[count > 0], 6)
        assert (sigs == [minhash.signature(s, 6) for s in filled]).all()
        assert (minhash.bands(sigs) == [minhash.bands(x[None])[0] for x in sigs]).all()


def test_words_are_told_apart_wherever_they_stand():
    letters = "a\0é€𝄞Zz"
    words = {"".join(random.Random(i).choices(letters, k=1 + i % 9)) for i in range(400)}
    words |= {c * k for c in "ab\0" for k in (7, 8, 9, 15, 16, 17, 63, 64, 65, 66, 127, 128, 5000)}
    words |= {"p" * k + "q" for k in (7, 8, 15, 16, 62, 63, 64, 65, 200)}
    words = sorted({w.encode().lower() for w in words})
    rng = random.Random(12)
    texts = [[]] + [rng.choices(words, k=rng.randint(0, 40)) for _ in range(100)] + [words, []]
    spaced = [b"".join(w + rng.choice([b" ", b"\n", b"\t\x0b\x0c\r "]) for w in t).upper() for t in texts]
    spaced[5] = b"  " + spaced[5]
    hashes, count = minhash.word_hashes(spaced)
    assert count.tolist() == [len(t) for t in texts]
    known = {}
    for w, h in zip([w for t in texts for w in t], hashes.tolist(), strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) == len(words)


def test_links_of_a_large_family_are_few_comparisons():
    # Copies of one text, of which some words are replaced: about half are linked, the others with nothing.
    rng = np.random.default_rng(11)
    base, sets, kept = np.arange(400, dtype=np.uint64), [], []
    for _ in range(1500):
        stays = rng.random(400) >= rng.uniform(0, 0.2)
        sets.append(np.sort(np.concatenate([base[stays], rng.integers(1000, 2**62, 400 - stays.sum()).astype(np.uint64)])))
        kept.append(stays)
    began = time.process_time()
    forest = list(minhash.linked(sets, 85))
    assert time.process_time() - began < 3
    kept = np.array(kept, np.float32)
    common = kept @ kept.T
    union = minhash.Union()
    for _ in sets:
        union.add()
    for i, j in np.argwhere(np.triu(100 * common >= 85 * (800 - common), 1)).tolist():
        union.join(i, j)
    found = minhash.Union()
    for _ in sets:
        found.add()
    assert all(found.join(i, j) for i, j in forest)
    roots = [union.find(i) for i in range(1500)]
    assert [found.find(i) for i in range(1500)] == roots and 300 < len(set(roots)) < 1200


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(i, 0) for i in range(61)} | {(k, 100) for k in range(100, 130)}


# --- rules ----------------------------------------------------------------------------------------


def test_measurements_equal_a_plain_count(docs, empty):
    expected = Counter()
    for doc_id, text in plain(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        kept = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        count = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
        expected[
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(kept) - len(set(kept)), len(covered)
        ] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter(tuple(r) for r in rules.measure(docs).select(names).collect()) == expected
    assert rules.ledger(empty).collect() == []


def test_policies_and_ablation_read_the_bits(docs):
    rows = rules.ledger(docs).cache()
    kept = rules.apply_policy(rows, "base-1").where("kept").count()
    both = rules.mask("base-1")
    bits = [r["failures"] for r in rows.select("failures").collect()]
    assert kept == sum(b & both == 0 for b in bits)
    for r in rules.ablation(rows, "base-1").collect():
        bit = 1 << list(rules.RULES).index(r["rule"])
        assert r["failed"] == sum(bool(b & bit) for b in bits)
        assert r["failed_alone"] == sum(b & both == bit for b in bits)
        assert r["kept_without"] == sum(b & both & ~bit == 0 for b in bits)


def test_rules_stay_in_the_jvm(docs):
    plan = rules.apply_policy(rules.ledger(docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- urls -----------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x", "http://a.example.org/en/12?q=1", "http://example.org",
    "http://notexample.org/es/1", "http://x.com/fr/1#f", "http://x.com/de/", "http://x.com/de", "http://x.net/de/1?a=b&c",
    "http://x.org//?://y.com/de/", "ftp://com/fr/", "http://user.com?/de/",
]


def test_longest_rule_wins(spark):
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for row in urls.filter_urls(rows).collect():
        url = URLS[row["page_id"]] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            (len(h + p), h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        assert (row["host"], row["path"]) == (host, path)
        assert (row["rule"], row["verdict"]) == (max(fits)[1:] if fits else (None, row["verdict"]))
    assert urls.filter_urls(rows.limit(0)).collect() == []


def test_mined_rules_equal_all_combinations(spark):
    from itertools import combinations

    rng = random.Random(6)
    rows = []
    for i in range(300):
        lang, top = rng.choice(["de", "fr", "es", "en"]), rng.choice(["com", "org", "net"])
        rows.append((i, f"http://h{rng.randrange(3)}.{top}/{lang}/{rng.randrange(5)}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    judged = urls.judged(pages).collect()
    known = [(frozenset(r["tokens"]), r["verdict"]) for r in {r["address"]: r for r in judged}.values() if r["verdict"]]
    confident = {}
    for size in (1, 2, 3, 4, 5):
        for items in {c for t, _ in known for c in combinations(sorted(t), size)}:
            has = [v for t, v in known if t >= set(items)]
            blocked = has.count("block")
            if blocked >= 0.05 * len(known) and blocked >= 2 and blocked >= 0.8 * len(has):
                confident[frozenset(items)] = blocked / len(has)
    least = {c for c in confident if not any(o < c for o in confident)}
    for row in urls.filter_urls(pages, min_support=0.05, least_urls=2).collect():
        tokens = set(judged[row["page_id"]]["tokens"]) if judged[row["page_id"]]["page_id"] == row["page_id"] else None
        if row["rule"] is None:
            assert row["verdict"] == ("block" if any(c <= tokens for c in least) else "allow")


def test_long_urls_have_few_tokens_and_one_example_makes_no_rule(spark):
    deep = "http://a.b.c.d.e.f.com/de/" + "/".join(f"s{i}" for i in range(40)) + "?" + "&".join(f"n{i}=1" for i in range(40))
    rows = [(i, deep, "x", 1) for i in range(50)]
    rows += [(50 + i, f"http://h.org/es/{i}", "x", 1) for i in range(100)]
    rows += [(150 + i, f"http://bad.com/de/{i}", "x", 1) for i in range(30)]
    rows += [(300 + i, f"http://good.com/fr/{i}", "x", 1) for i in range(100)]
    rows += [(200, "http://a.b.c.d.e.f.com/x/s1", "x", 1), (201, "http://bad.com/y", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, tokens string, address int")
    assert max(len(r["tokens"]) for r in urls.judged(pages).collect()) <= 11
    learned = {r["page_id"]: (r["verdict"], r["learned"]) for r in urls.filter_urls(pages).collect()}
    # The deep URL stands for one page, however often it is there; the other host for thirty.
    assert learned[200] == ("allow", None)
    assert learned[201] == ("block", "host=bad.com")


def test_all_segments_and_names_of_a_url_are_used(spark):
    def far(end, i, names=""):
        return "/".join(f"s{k}" for k in range(30)) + f"/{end}/{i}?a=1&b=1&c=1{names}"

    rows = [(i, "http://h.com/de/" + far("ads", i)) for i in range(30)]
    rows += [(100 + i, "http://h.com/fr/" + far("news", i)) for i in range(30)]
    # The thirty segments are in all of these, blocked or not, and two names block together only.
    rows += [(200 + i, f"http://k.com/de/{i}?a=1&b=1&c=1&y=1&z=1") for i in range(20)]
    rows += [(300 + i, f"http://k.com/fr/{i}?a=1&b=1&c=1&{n}=1") for i in range(20) for n in ("y", "z")]
    rows += [(1000, "http://other.net/x/" + far("ads", 1)), (1001, "http://other.net/x/" + far("news", 1))]
    rows += [(1002, "http://other.net/?a&b&c&y&z"), (1003, "http://other.net/?a&b&c&z")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    learned = {r["page_id"]: (r["verdict"], r["learned"]) for r in urls.filter_urls(pages).collect()}
    assert learned[1000] == ("block", "path31=ads") and learned[1001] == ("allow", None)
    assert learned[1002] == ("block", "query=y query=z") and learned[1003] == ("allow", None)


def test_urls_stay_in_the_jvm(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/1"), (2, "http://x.net/de/1")], "page_id long, url string")
    plan = urls.filter_urls(pages)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- decontamination ------------------------------------------------------------------------------


def test_copies_and_edits_are_found_and_clean_texts_left(spark):
    rng = random.Random(7)
    items = [prose(rng, 40) for _ in range(6)] + ["two words here", "", None]
    rows = [f"{prose(rng, 50)} {items[k]}. {prose(rng, 30)}" for k in range(6)]
    for k in range(6):
        words = items[k].split()
        for _ in range(6):
            words[rng.randrange(len(words))] = "edited"
        rows.append(f"{prose(rng, 9)} {' '.join(words).upper()} {prose(rng, 9)}")
    rows += [prose(rng, 200) for _ in range(20)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontam.contaminated(docs, bench).collect()
    assert {(r["id"], r["item_id"]) for r in found} == {(i, i % 6) for i in range(12)}
    for r in found:
        words = decontam.word_hashes(rows[r["id"]])
        assert len(decontam.word_hashes(items[r["item_id"]])) - 12 <= r["end_word"] - r["first_word"] <= len(words)
        if r["id"] < 6:
            assert r["score"] == 1.0
            assert (words[r["first_word"] : r["end_word"]] == decontam.word_hashes(items[r["item_id"]])).all()
    assert decontam.contaminated(docs.limit(0), bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []


def test_edited_variants_are_found_however_many_carry_them(spark):
    rng = random.Random(11)
    items, rows = [], []
    for carriers in (1, 16, 17, 500):
        for step in (4, 5):
            items.append(prose(rng, 40))
            words = [f"new{k}" if k % step == step - 1 else w for k, w in enumerate(items[-1].split())]
            rows += [f"{prose(rng, 9)} {' '.join(words)} {prose(rng, 9)}" for _ in range(carriers)]
    # Half an item, and one with as many words put between its own as the score allows.
    rows += [f"{prose(rng, 9)} {' '.join(items[0].split()[:21])}" for _ in range(20)]
    words = items[1].split()
    rows += [" ".join(words[:4] + [w for k, v in enumerate(words[4:]) for w in (f"more{k}", v)]) for _ in range(20)]
    rows += [prose(rng, 60) + " " + " ".join(items[k % 8].split()[:3]) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["id"], r["item_id"]): r["score"] for r in decontam.contaminated(docs, bench).collect()}
    hashed = [decontam.word_hashes(t) for t in rows]
    lengths = np.array([len(w) for w in hashed])
    windows = np.zeros((len(rows), lengths.max()), np.uint64)
    for k, w in enumerate(hashed):
        windows[k, : len(w)] = w
    expected = {}
    for i, item in enumerate(items):
        scores = decontam.smith_waterman(decontam.word_hashes(item), windows, lengths)[0] / 80
        expected |= {(k, i): scores[k] for k in np.flatnonzero(scores >= 0.5).tolist()}
    assert len(expected) >= 2 * (1 + 16 + 17 + 500) + 40
    assert found == expected


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 15)).astype(np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        best, _ = decontam.smith_waterman(a, b[None, :], np.array([len(b)]))
        assert best[0] == h.max()


# --- suffixes -------------------------------------------------------------------------------------


def test_suffixes_are_in_order():
    rng = random.Random(8)
    for _ in range(200):
        text = np.frombuffer(bytes(rng.choice(b"ab\x00c") for _ in range(rng.randint(0, 40))), np.uint8)
        order = suffixes.suffix_array(text, 50)
        assert sorted(order.tolist()) == list(range(len(text)))
        strings = [text[i:].tobytes().ljust(50, b"\0") for i in order]
        assert strings == sorted(strings)


@pytest.mark.parametrize(("hot", "together"), [(suffixes.HOT, suffixes.TOGETHER), (300, 500)])
def test_removed_bytes_equal_a_count_of_windows(docs, empty, hot, together):
    rows = [(d, t.encode()) for d, t in plain(docs)]
    windows = Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    expected = Counter()
    for doc_id, data in rows:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 199):
            if windows[data[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int(np.diff(gone.astype(int), prepend=0).clip(0).sum()) if len(data) else 0
        expected[doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in suffixes.dedup(docs, hot=hot, together=together).collect()) == expected
    assert suffixes.dedup(empty).collect() == []


def test_segments_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    data = prose(random.Random(9), 4000).encode()
    whole = fingerprints.segments(data, 200)
    monkeypatch.setattr(fingerprints, "CHUNK", 1000)
    parts = fingerprints.segments(data, 200)
    assert set(whole[0].tolist()) == set(parts[0].tolist())
    assert (parts[3] - parts[2] + 1).sum() == len(data) - 199
