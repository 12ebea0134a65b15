"""Cross-tokenizer alignment and phrase mining against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spinneret.llm import alignment, phrases, queries

ALIGNED = [
    None, "", " ", "one two  three", "Hello, wörld! 你好 \U0001f600", "a ▁ b", "<|endoftext|> <s> </s> <0x41>",
    "tab\tand\n new\nline ", "x" * 300, "antidisestablishmentarianism isn't 3.14159 20,000", "  nbsp   end",
    "same text here", "same text here", "the the the the", "word " * 5000 + "end", "\x00 nul", "don't  \r\n do",
]


def plain_alignment(texts):
    """Per text: ids of both, groups and links, or nothing."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = alignment.byte_alphabet()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def spell_b(i):
        piece = b.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    made = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ea = a.encode(" " + (text or ""), add_special_tokens=False)
        sides = [
            [(i, bytes(letters[c] for c in t)) for i, t in zip(ea.ids, ea.tokens)],
            [(i, spell_b(i)) for i in b.encode(text or "")],
        ]
        if not text or any(b"".join(x for _, x in side) != whole for side in sides):
            made.append(None)
            continue
        ends = []
        for side in sides:
            at, held = 0, []
            for i, x in side:
                at += len(x)
                held.append((at, i))
            ends.append(held)
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, before = [], 0
        for cut in cuts:
            groups.append([[i for e, i in held if before < e <= cut] for held in ends])
            before = cut
        links = [(x, y) for e, x in ends[0] for f, y in ends[1] if e == f] if len(whole) < 2000 else [
            (g[0][-1], g[1][-1]) for g in groups]
        made.append((len(ends[0]), len(ends[1]), groups, links))
    return made


def check_alignment(spark, docs, rows):
    plain = plain_alignment([text for _, text in rows])
    count = Counter(link for made in plain if made for link in made[3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = []
    for (doc_id, _), made in zip(rows, plain):
        if not made:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = made
        text = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        want.append((
            doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    got = alignment.align_tokenizers(docs, queries.tokenizer_path(), queries.tokenizer_path(queries.OTHER_TOKENIZER))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_alignment_equals_brute_force_on_made_texts(spark):
    rows = [*enumerate(ALIGNED), (3, "one two  three"), (None, "nobody's text"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, row int, pair string")
    check_alignment(spark, docs, rows)


def test_alignment_equals_brute_force_on_the_table(spark, small):
    docs = queries.documents(spark, small)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_alignment(spark, docs, [(i, t) for i, t in rows])


@pytest.mark.parametrize("function", ["align", "phrases"])
def test_empty_tables(spark, function):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    if function == "align":
        found = alignment.align_tokenizers(empty, queries.tokenizer_path(), queries.tokenizer_path(queries.OTHER_TOKENIZER))
    else:
        found = phrases.collocations(empty)
    assert found.collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=80), st.lists(st.booleans(), min_size=1, max_size=80), st.integers(0, 60))
def test_common_ends_equal_sets(left, right, same):
    size = max(len(left), len(right))
    ends = [np.array([i for i, x in enumerate(side) if x] + [size + k for k in range(same)], dtype=np.int64) for side in (left, right)]
    a, b = alignment.common_ends(*ends)
    common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    assert ends[0][a].tolist() == ends[1][b].tolist() == common


# Phrases

def plain_counts(rows):
    total, count = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    count[lang][tuple(words[i : i + size])] += 1
    return total, count


def plain_collocations(rows, least, top, covered=80):
    total, counts = plain_counts(rows)
    found = []
    for lang, count in counts.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        hidden = set()
        for longer, n in candidates.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    inner = longer[i : i + size]
                    if 100 * n >= covered * count[inner]:
                        hidden.add(inner)
        scored = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return found


PHRASES = [
    ("The quick brown fox jumps over. the QUICK brown fox; sleeps\tnow", "en"), ("", "en"), (None, "en"), (None, None),
    ("new york new york new york city", None), ("a a a a a a a a", "de"), ("x", "de"), ("...!!!", "de"),
    ("one two three four five six seven eight nine ten", "en"), ("one two three four five six seven eight nine ten", "en"),
    ("Ünder ünder \x1c weird\x0bline\x0cfeed\rend", "fr"), ("zero\x00nul zero\x00nul", "fr"),
    ("long " + "alpha beta gamma delta epsilon " * 3000, "es"), ("of the house of the house of the king", "en"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_phrases_equal_brute_force_on_made_texts(spark, least):
    rows = PHRASES + PHRASES[:2]
    docs = spark.createDataFrame([(t, g, "x", 1) for t, g in rows], "text string, lang string, word string, key int")
    got = phrases.collocations(docs.repartition(3), least=least, top=40)
    assert sorted(map(tuple, got.collect())) == sorted(plain_collocations(rows, least, 40))


def test_phrases_equal_brute_force_on_the_table(spark, small):
    docs = queries.documents(spark, small)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    got = phrases.collocations(docs, least=6).collect()
    assert len(got) > 50 and sorted(map(tuple, got)) == sorted(plain_collocations(rows, 6, 2000))


def test_colliding_words_take_another_seed(spark, monkeypatch):
    digest = phrases.xxhash.xxh64_intdigest
    texts = phrases._texts(spark.createDataFrame([("one two one two three", "en")], "text string, lang string"), "text", "lang")
    found, seed = phrases.count_words(texts, 1)
    assert seed == 0 and digest("one", 0) != digest("two", 0)
    class Same:
        @staticmethod
        def xxh64_intdigest(word, seed):
            return 7 if seed == 0 else digest(word, seed)

    words = phrases._Words(0)
    monkeypatch.setattr(phrases, "xxhash", Same)
    assert len(set(words.ids(["one two"]).tolist())) == 1
    assert len(set(phrases._Words(1).ids(["one two"]).tolist())) == 2


def test_paths_are_compacted(spark):
    rows = [("one two three four five six seven", "en")] * 3 + [("zero two three four five nine", "en")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {(r["passage"], r["n"]) for r in phrases.repeated_passages(docs, least=2).collect()}
    assert got == {
        ("one two three four", 3), ("zero two three four", 3), ("two three four five", 6),
        ("three four five six seven", 3), ("three four five nine", 3),
    }
