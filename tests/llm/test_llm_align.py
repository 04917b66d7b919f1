"""Token alignment against byte-by-byte brute force."""

import hashlib
import random
from collections import Counter

import pytest
from llm_helpers import clash, corpus, frame
from pyspark.sql import functions as F

from ridelake.llm import token_align

FILES = [f"{token_align.TOKENIZERS}/{n}" for n in (token_align.BYTE_BPE, token_align.PIECE_BPE)]


@pytest.fixture(scope="module")
def both():
    return token_align.Encoders(*[open(f, "rb").read() for f in FILES])


def brute(both, texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), from the token that covers each byte."""
    import sentencepiece
    import tokenizers
    t = tokenizers.Tokenizer.from_file(FILES[0])
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    per, counts = [], Counter()
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = s.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if b"".join(both.a_bytes[i] for i in a) != raw or b"".join(both.b_bytes[i] for i in b) != raw:
            a, b = [], []
        own_a = [k for k, i in enumerate(a) for _ in both.a_bytes[i]]
        own_b = [k for k, i in enumerate(b) for _ in both.b_bytes[i]]
        linked = [(a[x], b[y]) for x, y in sorted(set(zip(own_a, own_b)))]
        cuts = [k + 1 for k in range(len(own_a)) if k + 1 == len(own_a) or (own_a[k] != own_a[k + 1] and own_b[k] != own_b[k + 1])]
        groups, start = [], 0
        for end in cuts:
            x, y = sorted(set(own_a[start:end])), sorted(set(own_b[start:end]))
            groups.append(",".join(str(a[k]) for k in x) + "|" + ",".join(str(b[k]) for k in y))
            start = end
        counts.update(set(linked))
        per.append((len(a), len(b), groups, linked))
    high = Counter()
    for (x, _), n in counts.items():
        high[x] = max(high[x], n)
    return [(n_a, n_b, len(g), len(p), sum(counts[q] == high[q[0]] for q in p), sum(counts[q] for q in p), ";".join(g)) for n_a, n_b, g, p in per]


def awkward():
    rows = corpus(30)
    texts = ["Hello wörld <|endoftext|> <s> </s> <unk> 12\n\n  x", "a▁b", "▁", " ", "  ", "\t\r\n", "日本語 ﬁ é é 🙂👍🏽", "\x00\x01\x7f", "x" * 3000,
             "don't can't WE'LL 3.14159 1e10 http://a.b/c?d=e&f", "ab" * 500 + "é" * 200, " lead", "trail ", "<0x41>", "﻿bom", " nbsp　"]
    return rows + [(900 + i, t, "en", "s", 0) for i, t in enumerate(texts)]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 500])
def test_matches_brute_force(spark, both, chunk_bytes):
    rows = awkward()
    out = token_align.align(frame(spark, rows).repartition(3), chunk_bytes=chunk_bytes)
    got = sorted((str((r.doc_id, r.text)), *[r[n] for n in NAMES]) for r in out.collect())
    want = sorted((str((r[0], r[1])), *v) for r, v in zip(rows, brute(both, [r[1] for r in rows])))
    assert got == want
    assert out.count() == len(rows) and out.select("n_a").agg(F.sum("n_a")).first()[0] == sum(w[1] for w in want)
    assert any(w[1] == 0 and "▁" in w[0] for w in want) and sum(w[1] > 0 for w in want) > 30


def test_query_digest_and_clashing_columns(spark, both, tmp_path):
    rows = awkward()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = token_align.op11_diagonal_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", *NAMES[:-1], "groups_sha256"]
    want = brute(both, [r[1] for r in rows])
    digests = sorted((str(r[0]), hashlib.sha256(v[-1].encode()).hexdigest() if v[0] else "") for r, v in zip(rows, want))
    assert sorted((str(r.doc_id), r.groups_sha256) for r in out.collect()) == digests
    df = clash(frame(spark, rows)).withColumns({n: F.lit("mine") for n in (*NAMES, "chunk", "row", "pair", "times", "at", "dict_a", "docs", "best")})
    out = token_align.align(df)
    assert sorted(out.columns) == sorted(df.columns)
    assert sorted(r.groups for r in out.collect()) == sorted(v[-1] for v in want)
    assert out.where("chunk <> 'mine' OR row <> 'mine'").count() == 0
    assert token_align.align(frame(spark, [])).collect() == []
    assert [tuple(r[n] for n in NAMES) for r in token_align.align(frame(spark, [(1, None, "en", "s", 0)])).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_runs_cover_both_sides_and_group_only_at_common_ends():
    rng = random.Random(5)
    for _ in range(300):
        total = rng.randint(1, 60)
        a, b = (sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total))}) for _ in range(2))
        if rng.random() < 0.3:
            b = a[:-1] + [x for x in b if x > (a[-2] if len(a) > 1 else 0)]
        common, i, j, cuts = sorted(set(a) & set(b)), 0, 0, []
        for first, end, start, stop in token_align.runs(a, b):
            assert (first, start) == (i, j)
            i, j = end, stop
            if end - first == stop - start and a[first] == b[start]:
                assert a[first:end] == b[start:stop]
                cuts += a[first:end]
            else:
                assert end - first + stop - start > 2
                cuts.append(a[end - 1])
        assert cuts == common and (i, j) == (len(a), len(b))


def test_long_equal_stretches_take_few_probes():
    class Counting(list):
        probes = 0

        def __getitem__(self, at):
            if isinstance(at, slice):
                Counting.probes += 1
            return super().__getitem__(at)

    a = Counting(range(1, 100001))
    assert list(token_align.runs(a, list(a))) == [(0, 100000, 0, 100000)]
    assert Counting.probes < 40


def test_pieces_of_known_words_are_not_made_again(both, monkeypatch):
    """B is encoded word by word: the same ids as the whole text's, known words from memory."""
    fresh = token_align.Encoders(*[open(f, "rb").read() for f in FILES])
    assert fresh.by_word
    rng = random.Random(11)
    words = ["the", "straße", "x.\ny", "\tä", "1,234", "<s>", "</s>", "<0x41>", "q" * 300, "don't", "½ſ", "\x0b"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(200)]
    texts += [t + rng.choice(["", " ", "  x", "\x00", "▁", "日本"]) for t in texts] + [" " + t for t in texts[:50]]
    monkeypatch.setattr(token_align, "WORD_CHARS", 2000)  # forgotten on the way
    for t in texts:
        ids = fresh.b.encode(t)
        same = b"".join(fresh.b_bytes[i] for i in ids) == b" " + t.encode()
        assert fresh.encode_b(t) == (ids if same else None), t
    known = " ".join(words)
    want = fresh.encode_b(known)
    monkeypatch.setattr(fresh, "b", None)  # not asked
    assert fresh.encode_b(known) == want
