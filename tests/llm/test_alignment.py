import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from daygrid.llm import alignment as al
from daygrid.llm.queries import QUERIES, two_tokenizers

PATHS = two_tokenizers()

TEXTS = [
    None, "", "a", " ", "   two  spaces\n\n\nlines\t tab ", "Straße naïve 日本語 é \U0001f600 ▁ mark", "<|endoftext|> and <s> </s> <unk> <0x41>", "it's they'll 1234567 x=12.5%",
    "aaaaaaaa" * 40, " " * 5000 + "end", "\x00\x01 ﬁ   　 wide", "the the the the", "token " * 300, "\r\n\r\n", "a b",
]


def plain(docs):
    """Token by token and byte by byte, with both libraries on one text after another."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=PATHS[1])
    # The letters that byte-level vocabularies write for bytes.
    vocabulary = {i: t for t, i in first.get_vocab().items()}
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = [b for b in range(256) if b not in visible]
    letter = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(extra)}

    def spelt_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for doc_id, text in docs:
        whole = (" " + text).encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a, bytes_b = [bytes(letter[c] for c in vocabulary[i]) for i in a], [spelt_b(i) for i in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        spans = []
        for own in (bytes_a, bytes_b):
            at, found = 0, []
            for token in own:
                found.append((at, at + len(token)))
                at += len(token)
            spans.append(found)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        counts.update(links)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for cut in cuts:
            sides = [",".join(str(ids[k]) for k, (s, e) in enumerate(own) if last <= s and e <= cut) for ids, own in ((a, spans[0]), (b, spans[1]))]
            groups.append("|".join(sides))
            last = cut
        rows.append((doc_id, len(a), len(b), links, ";".join(groups), len(groups)))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        (doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
        for doc_id, n_a, n_b, links, g, n_groups in rows
    )


def found(docs, **options):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    return sorted(tuple(r) for r in al.alignment(docs, *PATHS, keep_groups=True, **options).select(*names).collect())


@pytest.mark.parametrize("block", [1, 300, al.BLOCK])
def test_against_brute_force(spark, block):
    draw = random.Random(2)
    docs = [*enumerate(TEXTS), (11, TEXTS[11]), (11, TEXTS[11])]
    docs += [(100 + i, "".join(draw.choices(["the ", "Token", "iz", "ation ", "é", "ß ", "  ", "\n", "123", "日本", "x"], k=draw.randint(1, 60)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3, "doc_id").selectExpr("doc_id", "text", "1L AS block", "2 AS pairs")
    want = plain(docs)
    assert found(frame, block_size=block) == want
    assert sum(r[1] == 0 for r in want) == 3  # some texts that one of the models cannot spell


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert found(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")) == [(i, 0, 0, 0, 0, 0, 0, "", "") for i in (1, 2)]


def test_fast_encoder_gives_the_ids_of_the_file():
    coder = al.encoder(PATHS[0])
    texts = [t or "" for t in TEXTS] + [" " * 3000 + "x", "\n" * 2500, "a" * 50_000, "!?" * 9000]
    assert coder.fast is not None and coder.ids(texts) == coder.plain([" " + t for t in texts])


def test_files_with_other_steps_are_left_to_their_library(tmp_path):
    from daygrid.llm.queries import tokenizer_path

    assert al.encoder(tokenizer_path()).fast is None


def test_numbers_round_trip():
    numbers = np.array([0, 1, 127, 128, 129, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1, 0, 5])
    data, size = al.packed_numbers(numbers)
    back, ends = al.unpacked_numbers(data)
    assert back.tolist() == numbers.tolist() and ends.tolist() == np.cumsum(size).tolist()
    assert [len(x) for x in al.unpacked_numbers(np.zeros(0, np.uint8))] == [0, 0]


def test_coalescing_by_hand():
    #  a: ab|c|def   b: a|bc|de|f
    got = al.aligned(np.array([2, 3, 6]), np.array([1, 3, 5, 6]), np.array([7, 8, 9]), np.array([1, 2, 3, 4]))
    assert got.group_a.tolist() == [0, 0, 1] and got.group_b.tolist() == [0, 0, 1, 1]
    assert list(zip(got.link_a.tolist(), got.link_b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3)]
    assert al.group_texts(got, np.array([0, 2]), 3) == [b"7,8|1,2", b"", b"9|3,4"]


def test_query(spark, tmp_path):
    """The registered query, over a table of texts with the planted edge cases, against the plain version."""
    draw = random.Random(6)
    docs = [*enumerate(TEXTS), *((50 + i, " ".join(draw.choices("the tokens of naïve words, 12 34 ß x=1 日".split(), k=40))) for i in range(20))]
    spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in QUERIES["op11_token_alignment"](spark, str(tmp_path)).select(*names).collect()) == [r[:8] for r in plain(docs)]
