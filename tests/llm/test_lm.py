"""Learning of the language model: from all training documents, whole, each once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstrata.llm import lm
from reelstrata.llm.common import ship, stored
from reelstrata.llm.tokencount import VOCABULARY, encoder

ODD = ["One two  TWO\x0bthree-four", None, "", " \t\n\x0b ", "zwei drei 　 x y don't i'm 12ab a\x1cb \x85", "東京 ▁ \x00 \U0001f600 ñandú\x0c", "x " * 50]


def frame(spark, texts):
    ship(spark)
    rows = [(i, t) for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def spelled(text):
    words = (text or "").encode().lower().split()
    return [i for w in words for i in encoder(VOCABULARY).encode_ordinary(" " + w.decode())] + [lm.END]


def test_what_stands_late_in_a_long_document_is_learned(spark):
    """Both corpora have the same words and the same first 5,400 characters."""
    same, held = "ab cd " * 900, 6
    assert frame(spark, ["x"] * held).where(lm.held_out(F.col("doc_id"))).first().doc_id == held

    def scored(tail):
        texts = [same + tail] + [None] * (held - 2) + ["ef gh ef gh ab"]
        return lm.score(frame(spark, texts)).where(f"doc_id = {held}").first()

    a, b = scored("ef gh " * 300), scored("ef " * 300 + "gh " * 300)
    assert (a.base_score, a.n_known, a.train_tokens) == (b.base_score, b.n_known, b.train_tokens)
    assert abs(a.score - b.score) > 1e-3


def test_subwords_of_a_block_are_those_of_its_texts(spark):
    row = lm.blocks(frame(spark, ODD)).collect()
    assert len(row) == 1 and list(row[0].doc_ids) == [*range(1, len(ODD) + 1)]
    for keep in (np.ones(len(ODD), bool), np.arange(len(ODD)) % 2 == 0):
        ids, lengths = lm.identifiers(row[0].asDict(), keep)
        wanted = [spelled(t) for t, k in zip(ODD, keep) if k]
        assert [len(t) for t in wanted] == lengths.tolist() and sum(wanted, []) == ids.tolist()


def test_words_are_spelled_in_one_go_as_one_by_one():
    odd = ["a\x1cb", "\x85", "abc", "don't", "　　x", "y　", "\x1c", "12ab", "x\u200b", "\xa0y", "'s", "'", "\ufeffa", "東京"]
    for words in (odd, odd[::-1], ["\x85"], ["abc", "'s"], []):
        ids, sizes = lm.spellings(VOCABULARY, words)
        wanted = [encoder(VOCABULARY).encode_ordinary(" " + w) for w in words]
        assert ids.tolist() == sum(wanted, []) and sizes.tolist() == [len(w) for w in wanted]


def test_scores_are_those_of_a_plain_forward_pass_and_no_place_is_computed_twice():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 15, 16, 17, 28, 29, 100])
    ids = rng.integers(0, 2000, lengths.sum()).astype(np.int32)
    class_of, member, share = lm.classes(np.arange(lm.IDS)[::-1].astype(float))
    model, starts = lm.Model(lm.initial(), class_of, member, share), np.cumsum(lengths) - lengths
    wanted = []
    for start, n in zip(starts, lengths):
        text, total = ids[start : start + n], 0.0
        inputs = np.append(lm.END, text[:-1])
        for at, size, scored in zip(*lm.spans(np.array([n]))[1:]):
            f = lm.forward(model.weights, inputs[None, at : at + size])[0][0]
            targets = text[at : at + size]
            logs = lm.log_probabilities(model.weights, f, class_of[targets], member[targets]) + share[targets]
            total += logs[scored:].sum()
        wanted.append(total / np.log(10))
    assert lm.scores(model, ids, lengths) == pytest.approx(np.array(wanted), rel=1e-4)
    # windows of one shape go together: of each, only places that are scored reach the softmax
    chunks = list(lm.windows(ids, starts, lengths))
    assert sum(targets.size for _, targets, *_ in chunks) == lengths.sum()
    assert all(inputs.shape[1] == targets.shape[1] + skip for inputs, targets, skip, _ in chunks)


def test_each_training_document_is_learned_once_and_weights_are_the_mean_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(lm, "ROUNDS", [(16, 1e-2)])
    texts = [f"w{i % 7} v{i % 11} " * (i % 13) for i in range(60)]
    docs = frame(spark, texts)
    train = [spelled(r.text) for r in docs.where(~lm.held_out(F.col("doc_id"))).orderBy("doc_id").collect()]
    one, counts = stored(lm.blocks(docs), "blocks"), np.bincount(np.concatenate(train), minlength=lm.IDS).astype(float)
    assert (lm.subword_counts(one) == counts).all()
    class_of, member, _ = lm.classes(counts)
    start = lm.initial()
    start["token"][counts == 0] = 0
    learner = lm.Learner(start, class_of, member)
    learner.learn(np.concatenate(train).astype(np.int32), np.array([len(t) for t in train]), 1e-2)
    assert learner.seen == learner.met.sum() == counts.sum()
    for tasks in (one, one.unionAll(one)):  # two equal tasks have the mean of one
        got = lm.learned(tasks, counts, class_of, member)
        for k, v in learner.weights.items():
            assert got[k] == pytest.approx(v, abs=1e-5), k
