"""Conversation repair, lexical search and line dedup against brute force, their SQL, and at their edges."""

import hashlib
import itertools
import random
import re
from collections import Counter
from math import floor, log

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelstrata.llm import lexical, linededup, repair
from reelstrata.llm.common import ship, stored

NOTHING = hashlib.sha256(b"").hexdigest()


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def by_sql(sql, **tables):
    database = duckdb.connect()
    for name, table in tables.items():
        database.register(name, table)
    relation = database.sql(sql)
    names = [d[0] for d in relation.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=key)


def by_spark(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(r) for r in frame.select(*names).collect()), key=key)


# --- 11 ------------------------------------------------------------------------------------------------------------

GAPS = ["", "u", "a", "uu", "ua", "au", "aa"]


def cheapest(codes):
    """The least cost and initials over every choice of edits with up to two inserts between rows."""
    ways = []
    for own in itertools.product(("D", "K", "Ru", "Ra"), repeat=len(codes)):
        cost, parts = 0, []
        for code, edit in zip(codes, own):
            cost += {"D": 3, "K": 0}.get(edit, 2)
            if edit != "D":
                if code >= repair.BLANK:
                    break
                cost += code >= repair.TRUNCATED
            parts.append("" if edit == "D" else "suax"[code % 4] if edit == "K" else edit[1])
        else:
            for gaps in itertools.product(GAPS, repeat=len(codes) + 1):
                roles = gaps[0] + "".join(p + g for p, g in zip(parts, gaps[1:]))
                if re.fullmatch("(s?(ua)+)?", roles):
                    audit = "I" * len(gaps[0]) + "".join(o[0] + "I" * len(g) for o, g in zip(own, gaps[1:]))
                    ways.append((cost + 2 * sum(map(len, gaps)), audit))
    return min(ways)


@pytest.mark.parametrize("length", [0, 1, 2])
def test_edits_are_the_cheapest_and_least(length):
    for codes in itertools.product(range(10), repeat=length):
        cost, walk = repair.edits(bytes(codes))
        assert (cost, "".join(walk)) == cheapest(codes), codes


def forward(codes):
    """The least (cost, initials) of every state, row by row."""
    ways = {repair.EMPTY: (0, "")}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                to, new = repair.TURN_STATE[state], (cost + 2, audit + "I")
                ways[to] = min(ways.get(to, new), new)
        return ways

    for code in codes:
        after = {}
        for state, (cost, audit) in inserted(ways).items():
            found = [(state, cost + 3, "D")]
            if code < repair.BLANK:
                extra = int(code >= repair.TRUNCATED)
                found.append((repair.TURN_STATE[state], cost + 2 + extra, "R"))
                if repair.kept_state(code, state) is not None:
                    found.append((repair.kept_state(code, state), cost + extra, "K"))
            for to, c, initial in found:
                after[to] = min(after.get(to, (c, audit + initial)), (c, audit + initial))
        ways = after
    ways = inserted(ways)
    return min(ways[s] for s in (repair.EMPTY, repair.ASSISTANT) if s in ways)


def test_checkpoints_do_not_change_the_edits():
    draw = random.Random(5)
    for length in (3, 4, 8, 9, 10, 63, 64, 65, 700):
        for _ in range(20 if length < 100 else 2):
            codes = bytes(draw.choices(range(10), weights=[1, 4, 4, 1, 1, 2, 2, 1, 1, 1], k=length))
            cost, walk = repair.edits(codes)
            walk = list(walk)
            assert len(walk) == length + 1
            assert (cost, "".join(walk)) == forward(codes)


CONVERSATION = "conv_id long, turn long, role string, text string, kind int, code string, digest int, first_turn int, CONV string"


def conversation_rows():
    draw = random.Random(3)
    texts = ["Yes.", "No!", "why?", "cut off", "  ", "", None, "x.\n\t", "a\nb.", "é…", "done. \x0b", " "]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(draw.randint(1, 9)):
            turn = draw.choice([turn, turn, turn, turn * 3, 2, None, -4])
            rows.append((conv, turn, draw.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], draw.choice(texts)))
    return rows + rows[:12] + [(900, 1, "user", "long " * 60_000 + "end."), (901, None, None, None), (902, 7, "assistant", "z." * 5)]


@pytest.fixture(scope="module")
def conversations(spark):
    ship(spark)
    rows = [(*r, 1, "c", 2, 3, "d") for r in conversation_rows()]
    return stored(spark.createDataFrame(rows, CONVERSATION).repartition(3), "conversations")


def test_repair_equals_sql(conversations):
    table = pd.DataFrame(conversation_rows(), columns=["conv_id", "turn", "role", "text"])
    table = table.astype({"conv_id": "Int64", "turn": "Int64"})
    assert by_spark(repair.repaired_conversations(conversations)) == by_sql(repair.REPAIR_SQL, conversations=table)


def test_repaired_rows_have_the_hash_and_the_order(conversations):
    rows = repair.damaged(conversations)
    found = {}
    for r in repair.repair(rows).orderBy("conv_id", "position").collect():
        found.setdefault(r.conv_id, []).append(r)
    reports = {r.conv_id: r for r in repair.reports(rows).collect()}
    for conv_id, report in reports.items():
        turns = found.get(conv_id, [])
        assert [r.position for r in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))
        assert "".join(r.edit for r in turns) == report.audit.replace("D", "")
        text = "\n".join(f"{r.role}:{r.text}" for r in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == report.repaired_sha256


def test_a_conversation_with_most_rows(spark):
    ship(spark)
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t % 701}.") for t in range(6_000)] + [(2, 0, "user", "a.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report = {r.conv_id: r for r in repair.reports(table).collect()}[1]
    seen, codes = set(), bytearray()
    for _, _, role, text in rows[:-1]:
        codes.append(repair.DUPLICATE if (role, text) in seen else repair.ROLES.index(role[0]))
        seen.add((role, text))
    assert (report.cost, report.audit) == forward(codes)
    assert report.duplicate == 6_000 - 1_402 and report.illegal == report.gaps == 0


def test_repair_of_nothing(conversations):
    assert repair.repaired_conversations(conversations.where("false")).collect() == []
    assert repair.repair(conversations.where("false").select("conv_id", "turn", "role", "text")).collect() == []


def test_a_dropped_conversation_keeps_its_row(spark):
    ship(spark)
    ids = spark.range(400).where(F.crc32(F.concat("id", F.lit(":0")).cast("binary")) % 20 == 0).select("id")
    table = ids.select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("x.").alias("text"))
    rows = repair.repaired_conversations(table).collect()
    assert len(rows) == ids.count() > 0
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", NOTHING)}


# --- 12 ------------------------------------------------------------------------------------------------------------


def terms_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked_by_hand(docs, items, k=20):
    counts = [(i, Counter(terms_by_hand(t))) for i, t in docs]
    counts = [(i, tf, sum(tf.values())) for i, tf in counts if tf]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, tf, _ in counts for t in tf)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, tf, n in counts:
            m = 75 + 25 * n * n_docs // n_terms
            w = lambda t: floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms_by_hand(text) if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=key)


def corpus():
    draw = random.Random(8)
    words = [f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(4_000)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60)))) for i in range(300)]
    docs += [(i + 1_000, docs[i % 7][1].upper()) for i in range(60)]  # copies tie
    docs += [(None, docs[3][1]), (None, "Ünï-código w1 W1"), (5, docs[5][1]), (2_000, None), (2_001, ""), (2_002, " .,;\x7f\x00"),
             (2_003, "w1 " * 50_000 + "ÀÉ東京"), (2_004, "a_b`c{d}")]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 30)))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "--"), (28, "nowhere found"), (3, "w1 w1 w2"), (None, "ünï 東京 B"), (30, "ÀÉ東京 código")]
    return docs, items


def test_ranks_equal_brute_force(spark):
    ship(spark)
    docs, items = corpus()
    table = spark.createDataFrame([(*d, "x", 1, 2.0) for d in docs], "doc_id long, text string, score string, n int, number double")
    asked = spark.createDataFrame([(*i, 4) for i in items], "item_id long, text string, doc_id long")
    got = lexical.search(table.repartition(5), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == ranked_by_hand(docs, items)
    frames = pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}), pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"})
    names, rows = by_sql(lexical.SEARCH_SQL, documents=frames[0], benchmark=frames[1])
    assert by_spark(got) == (names, rows)


def test_search_without_documents_or_items(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert lexical.search(docs.where("false"), items).collect() == []
    assert lexical.search(docs, items.where("false")).collect() == []
    found = lexical.search(docs, items)
    assert [tuple(r) for r in found.collect()] == [(1, 1, 1, found.first().score)]
    assert dict(found.dtypes)["item_id"] == "int"


def test_blocks_of_items_do_not_change_the_ranks(spark):
    class Row:
        def __init__(self, item_id, text):
            self.item_id, self.text = item_id, text

    items = [Row(i, "a b c " * (i % 4)) for i in range(50)]
    blocks = list(lexical.item_blocks(items, most_terms=20, most_items=5))
    assert all(len(b) <= 5 and (len(b) == 1 or sum(len(t) for *_, t in b) <= 20) for b in blocks)
    assert [n for b in blocks for n, *_ in b] == [i for i in range(50) if i % 4]


@pytest.mark.parametrize("step", [1, 4, 64])
def test_best_positions_find_the_first_k_and_stop_early(step, monkeypatch):
    monkeypatch.setattr(lexical, "STEP", step)
    rng = np.random.default_rng(2)
    size, lists, k = 3_000, 5, 7
    dense = np.where(rng.random((lists, size)) < 0.6, (rng.pareto(1.0, (lists, size)) * 50).astype(np.int64) + 1, 0)
    dense[:, :30] = dense[:, :1]  # equal scores
    term, doc = np.nonzero(dense)
    shard = lexical.Shard(doc, term, dense[term, doc], size)
    weight = [3, 1, 4, 1, 5]
    whole = (np.array(weight)[:, None] * dense).sum(0)
    for floor_score in (0, int(np.sort(whole)[-3]), int(whole.max()) + 1):
        docs, scores, depth = lexical.best_positions(shard, list(range(lists)), weight, floor_score, k)
        assert (whole[docs] == scores).all() and len(set(docs.tolist())) == len(docs)
        kth = max(int(np.sort(whole)[-k]), floor_score)
        assert set(np.nonzero(whole >= kth)[0]) <= set(docs.tolist())
        assert depth < size // 3


# --- 13 ------------------------------------------------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"


def dropped_by_hand(docs, min_documents=10, min_chars=1):
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(BLANKS))
    lines = [(i, (t or "").split("\n")) for i, t in docs]
    count = Counter(k for _, ls in lines for k in {fold(line) for line in ls})
    out = []
    for i, ls in lines:
        kept = [line for line in ls if len(fold(line)) < min_chars or count[fold(line)] < min_documents]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def line_documents():
    draw = random.Random(4)
    pool = ["Header", " header\t", "HEADER\r", "", "  ", "Ärger", "ärger", "tail \x0b", " ", "x\x00y", "menu", "Menu "]
    docs = [(i, "\n".join(draw.choices(pool + [f"own {i} {k}" for k in range(12)], k=draw.randint(1, 14)))) for i in range(80)]
    docs += [(100 + i, "same\ntext\nkept\n") for i in range(12)] + [(3, docs[3][1]), (None, docs[3][1]), (None, "header"), (None, None)]
    return docs + [(200, None), (201, ""), (202, "\n\n"), (203, "header\n" * 3_000 + "unique end"), (204, "header\nMenu")]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(*d, 1, "q", 5, "t", "g") for d in line_documents()]
    schema = "doc_id long, text string, n_lines int, `keys` string, A int, t string, gone string"
    return stored(spark.createDataFrame(rows, schema).repartition(4), "lines")


@pytest.mark.parametrize(("min_documents", "min_chars"), [(10, 1), (2, 1), (10, 0), (10, 5), (10**6, 1)])
def test_dropped_lines_equal_brute_force(lines, min_documents, min_chars):
    got = linededup.drop_lines(lines, min_documents, min_chars)
    assert got.columns == [*lines.columns, "n_lines_", "n_dropped"]
    found = sorted((tuple(r) for r in got.select("doc_id", "n_lines_", "n_dropped", "text").collect()), key=key)
    assert found == sorted(dropped_by_hand(line_documents(), min_documents, min_chars), key=key)
    assert {tuple(r) for r in got.select("n_lines", "`keys`", "A", "t", "gone").collect()} == {(1, "q", 5, "t", "g")}


def test_line_dedup_equals_sql(lines):
    table = pd.DataFrame(line_documents(), columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    assert by_spark(linededup.line_dedup(lines)) == by_sql(linededup.LINE_SQL, documents=table)


def test_line_dedup_of_nothing_and_without_python(lines):
    assert linededup.line_dedup(lines.where("false")).collect() == []
    plan = linededup.line_dedup(lines)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_line_is_classified_and_wrapped_notices_are_found(spark):
    from reelstrata.llm import license

    others = ["the river was wide and the boat was small", "a song about rain and wind in the hills", "numbers of the year were good"]
    model = license.train(others * 20)
    family, notice = next((f, t) for f, t in license.TEMPLATES if t.startswith("Redistribution and use"))
    words = notice.split()
    wrapped = "\n".join(" ".join(words[k : k + 4]) for k in range(0, len(words), 4))
    # the template without its licence word keeps most of its pairs
    plain = " ".join(w for w in words if not w.startswith("Redistribut"))
    assert not any(stem in plain.lower() for stem in license.STEMS)
    rows = [(1, f"title\n\n# {wrapped}\n \n{others[0]}"), (2, f"{others[0]}\n{plain}"), (3, notice), (4, "\n\n".join(others)), (5, None), (6, "")]
    found = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {i: found[i].license for i in found} == {1: family, 2: family, 3: family, 4: "none", 5: "none", 6: "none"}
    assert [found[i].n_confirmed for i in range(1, 7)] == [1, 1, 1, 0, 0, 0]
    assert [found[i].n_marked for i in range(1, 7)] == [1, 0, 1, 0, 0, 0]
    assert found[1].similarity == 1.0 and found[3].n_paragraphs == 1
