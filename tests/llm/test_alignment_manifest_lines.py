"""Alignment, manifest and line dedup against brute force and DuckDB, on whole tables and odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeveil.llm import alignment, line_dedup, manifest, queries
from lakeveil.llm.common import documents
from lakeveil.llm.parameters import BYTE_MODEL, tokenizer_model
from suite.compare import difference

MIDDLE = "/root/testdata/sf0.01"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, place bigint, digest string,"
    " block int, pairs string, lines string, lv_file string, n int"
)


def frame(spark, rows):
    """Rows (doc_id, text[, lang]) with further columns whose names the operators use themselves."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 3, "t", 1, "d", 1, "p", "l", "f", 1) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


# ---------------------------------------------------------------- alignment


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokenizer_model(BYTE_MODEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_model())


def plain_alignment(models, rows):
    """{row number: measures} with whole texts tokenised at once and every pair of ranges compared."""
    a_model, b_model = models
    letters = alignment._byte_letters()
    links_of, counts, found = {}, collections.Counter(), {}
    for at, text in enumerate(rows):
        raw = (" " + text).encode() if text else b""
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
            else b_model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not raw or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            links_of[at], found[at] = [], (0, 0, 0, 0, "")
            continue
        spans = []
        for ids, parts in ((a, bytes_a), (b, bytes_b)):
            end, side = 0, []
            for i, part in zip(ids, parts):
                side.append((i, end, end + len(part)))
                end += len(part)
            spans.append(side)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, links, low = [], [], 0
        sides = [collections.deque(s) for s in spans]
        for end in ends:
            inside = [[], []]
            for k in (0, 1):
                while sides[k] and sides[k][0][2] <= end:
                    inside[k].append(sides[k].popleft())
            groups.append("|".join(",".join(str(i) for i, *_ in part) for part in inside))
            links += [(i, j) for i, s, e in inside[0] for j, t, f in inside[1] if s < f and t < e]
            low = end
        assert low == len(raw)
        links_of[at] = links
        counts.update(links)
        found[at] = (len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest())
    most = collections.Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (*found[at][:4], sum(counts[p] == most[p[1]] for p in links_of[at]), sum(counts[p] for p in links_of[at]), found[at][4])
        for at in range(len(rows))
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_a_table_against_whole_texts(spark, models):
    docs = documents(spark, MIDDLE)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = {i: m for (i, _), m in zip(rows, plain_alignment(models, [t for _, t in rows]))}
    found = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, MIDDLE).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found} == expected


def odd_texts():
    draw = random.Random(5)
    alphabet = list("ab xyz.,'\"-_()  \n\n\t\r\x0b\x1c0123éßñ漢字\U0001f600") + [" ", " ", "'s", " ", " ", "\x00", "the"]
    made = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 60))) for _ in range(400)]
    fixed = [
        None, "", " ", "  ", "\n", " \n ", "a", " a", "a ", "a  b", "\n\nx", "x \n y", "with ▁ mark", "▁",
        "<|endoftext|> and <s> </s> <unk> <0x0A>", "x" * 5000, "ab " * 4000, "same", "same", "é ñ", " 's 't",
    ]
    return fixed + made


def test_alignment_of_odd_texts(spark, models, monkeypatch):
    texts = odd_texts()
    expected = plain_alignment(models, texts)
    docs = frame(spark, list(enumerate(texts)))
    found = alignment.aligned(docs, tokenizer_model(BYTE_MODEL), tokenizer_model(), block_bytes=2000).collect()
    assert len(found) == len(texts)
    wrong = [(texts[r.doc_id], tuple(r[c] for c in COLUMNS)) for r in found if tuple(r[c] for c in COLUMNS) != expected[r.doc_id]]
    assert not wrong, wrong[:3]


def test_alignment_of_long_texts_in_parts(models):
    text = " ".join(["alpha beta\ngamma", "x" * 70, "", "delta   epsilon"] * 300)
    parts = list(alignment.chunks(text, 100))
    assert len(parts) > 50 and " ".join(parts) == text
    with open(tokenizer_model(BYTE_MODEL), "rb") as one, open(tokenizer_model(), "rb") as other:
        aligner = alignment.Aligner(alignment.byte_ranks(one.read()), other.read())
    in_parts = [w for part in parts for w in aligner.words(part)]
    assert aligner.cuttable and in_parts == aligner.words(text)


def test_alignment_of_no_and_repeated_rows(spark):
    files = tokenizer_model(BYTE_MODEL), tokenizer_model()
    assert alignment.aligned(frame(spark, []), *files).count() == 0
    twice = alignment.aligned(frame(spark, [(1, "one two"), (1, "one two"), (None, "one two"), (None, None)]), *files).collect()
    assert [r.count_sum for r in twice if r.n_a] == [3 * twice[0].n_links] * 3 if twice[0].n_a else True
    assert sorted(r.n_a for r in twice) == [0, 2, 2, 2]


# ----------------------------------------------------------------- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """[(doc_id, leaf, subroot, root, proof, folded)] from lists of lists."""
    def leaf(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def steps(levels, at):
        for level in levels[:-1]:
            low = at // 8 * 8
            yield level[low:at], level[at + 1 : low + 8]
            at //= 8

    by_lang = collections.defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        ordered = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[lang] = ordered, tree([leaf(r, r[1]) for r in ordered])
    top = tree([trees[lang][1][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        ordered, levels = trees[lang]
        for at, row in enumerate(ordered):
            path = list(steps(levels, at)) + list(steps(top, place))
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(row, text)
            for left, right in path:
                folded = H(*left, folded, *right)
            out.append((row[0], levels[0][at], levels[-1][0], top[-1][0], H(*[s for l, r in path for s in (*l, *r)]), folded))
    return out


def manifest_rows(spark, rows):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, place int, root string")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    claimed = F.when(tampered, line_dedup.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    found = manifest.manifest(docs, claimed).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in found)
    return [tuple(r)[:6] for r in found]


def made_rows(sizes):
    draw = random.Random(3)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = draw.choice([None, "", "Plain text", "ÉCOLE Á", "lower", "X" * 3000])
            rows.append((draw.choice([None, draw.randrange(10**9), 7]), text, lang, draw.choice([None, "src"]), draw.choice([None, 4])))
    return rows


key = lambda r: tuple(str(v) for v in r)


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_against_lists(spark, monkeypatch, height):
    """With superblocks of 8 nodes several levels are exchanged; the tables are the same."""
    rows = made_rows({None: 1, "": 9, "de": 8, "en": 150, "zh": 64, "é": 65, "Z": 1})
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "SUPERBLOCK", 8**height)
    assert sorted(manifest_rows(spark, rows), key=key) == sorted(plain_manifest(rows), key=key)


def test_manifest_of_one_row_one_lang_and_none(spark):
    for rows in ([(5, "A", "en", None, None)], made_rows({"en": 20}), made_rows({c: 1 for c in "abcdefghijkl"})):
        assert sorted(manifest_rows(spark, rows), key=key) == sorted(plain_manifest(rows), key=key)
    assert manifest_rows(spark, []) == []
    lone = manifest_rows(spark, [(1, None, None, None, None)])[0]
    assert lone[1] == lone[2] == lone[3] == lone[5] and lone[4] == H()


def test_manifest_without_a_claim_verifies(spark):
    found = manifest.manifest(documents(spark, MIDDLE))
    assert found.where("NOT verified").isEmpty() and found.select("root").distinct().count() == 1


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_line_dedup"])
def test_agrees_with_sql(spark, small, duck, name):
    assert difference(queries.QUERIES[name](spark, small), duck, queries.ORACLES[name]) is None


# --------------------------------------------------------------- line dedup


def plain_lines(rows):
    holders, out = collections.defaultdict(set), []
    def key_of(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders[key_of(line)].add(i)
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key_of(x), ())) < 2 or min(holders[key_of(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_of_odd_texts(spark):
    draw = random.Random(9)
    pool = ["", " ", "short", "Exactly10!", "exactly10!\r", "\t EXACTLY10! ", "\x85exactly10!", "ÄÖÜ long enough", "äöü long enough",
            "  a line that all have  ", "漢字漢字漢字漢字漢字", " exactly10!", "x" * 4000, "nine char"]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randrange(0, 12)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "a line that all have\n" * 3000 + "end of it all"), (204, "one line of 204")]
    found = line_dedup.line_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found) == sorted(plain_lines(rows))
    assert all(r.kept_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in found)


def test_line_dedup_of_repeated_null_and_no_rows(spark):
    line = "the same line everywhere"
    found = line_dedup.line_dedup(frame(spark, [(3, line), (3, line), (4, line), (None, line), (None, line)])).collect()
    assert sorted((str(r.doc_id), r.n_dropped) for r in found) == [("3", 0), ("3", 0), ("4", 1), ("None", 1), ("None", 1)]
    found = line_dedup.line_dedup(frame(spark, [(None, line), (None, line)])).collect()
    assert [r.n_dropped for r in found] == [0, 0]
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0
    higher = line_dedup.line_dedup(frame(spark, [(1, line), (2, line), (3, "other line entirely")]), min_documents=3)
    assert higher.agg(F.sum("n_dropped")).first()[0] == 0


def test_line_dedup_runs_no_python(spark, small):
    plan = line_dedup.line_dedup(documents(spark, small))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" not in plan
