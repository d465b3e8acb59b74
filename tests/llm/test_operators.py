"""Each operator against brute force on small rows: nulls, empty and long texts, ties, repeats, extra columns, empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm import language_id, packing, quotations, substring_dedup, surrogates, templates, token_counts, token_records
from orderlake.llm.cross_polytope import nearest
from orderlake.llm.near_dedup import near_duplicates
from orderlake.llm.ship import ship
from orderlake.llm.storage import new_folder

BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, doc int, th string"


@pytest.fixture(scope="module")
def sent(spark):
    ship(spark)
    return spark


def documents():
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdeéñ") for _ in range(draw.randint(2, 6))) for _ in range(200)]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base, passage = text(60), text(20)
    rows = [(n, f"{text(15)} {passage}\n{text(10)}") for n in range(6)]
    rows += [(10 + n, base) for n in range(5)] + [(20, base + " tail"), (21, base.replace(" ", "  \t", 1)), (30, None), (31, ""), (32, " \n\t"), (33, "one"), (33, "one"), (None, base)]
    rows += [(40, text(3000)), (41, "same " * 400), (42, "Same " * 300), (43, "I'm <|endoftext|> here, 3.5% é🙂")]
    return [(i, t, "en", 1, "x") for i, t in rows]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substring_dedup_against_brute_force(sent):
    rows = documents()
    first = {}
    for i, t, *_ in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            if i is not None:
                first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
    want = []
    for i, t, *_ in rows:
        w = words_of(t)
        gone = {k + j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    docs = sent.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in substring_dedup.remove_repeats(docs).drop("kept_text").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(w[2] for w in want)
    assert substring_dedup.remove_repeats(docs.limit(0)).collect() == []


def test_heavy_minimisers_change_the_route_only(sent, monkeypatch):
    rows = [r for r in documents() if r[0] is not None]
    docs = sent.createDataFrame(rows, SCHEMA)
    plain = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    w = substring_dedup.words(pa.array([t for _, t, *_ in rows]))
    hot = np.unique(substring_dedup.runs(w, 13, np.zeros(0, np.uint64))[2])[::2]
    monkeypatch.setattr(substring_dedup, "_heavy", lambda *a: (hot, 10_000))
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs).collect())) == plain


def test_neighbours(sent):
    draw = np.random.default_rng(1)
    rows = [(n, draw.normal(size=16).tolist(), 1) for n in range(400)]
    rows += [(500 + n, rows[0][1], 1) for n in range(30)] + [(600, None, 1), (700, [0.0] * 16, 1), (800, [float("nan")] * 16, 1), (900, [None] * 16, 1), (None, rows[3][1], 1), (0, rows[0][1], 1)]
    table = sent.createDataFrame(rows, "vec_id long, embedding array<double>, id int")
    got = nearest(table, F.col("vec_id") % 100 == 0).collect()
    good = {i: np.array(v) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    found = total = 0
    for q in [i for i in good if i % 100 == 0]:
        order = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        if order[9][0] == 0:
            assert [r[1] for r in own] == [i for _, i in order]
        found, total = found + len({r[1] for r in own} & {i for _, i in order}), total + 10
    assert found / total >= 0.9 and {r["query_id"] for r in got} == {q for q in good if q % 100 == 0}
    assert nearest(table.limit(0), F.lit(True)).collect() == []
    assert len(nearest(table.filter("vec_id < 3"), F.lit(True)).collect()) == 6


def test_records_round_trip(sent):
    rows = documents()
    docs = sent.createDataFrame(rows, SCHEMA)
    got = token_records.id_digests(token_records.read_records(token_records.write_records(docs, new_folder(sent, "t"), BPE, 2))).collect()
    encode = Tokenizer.from_file(BPE)
    start, want = 0, []
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_records.read_records(token_records.write_records(docs.limit(0), new_folder(sent, "t"), BPE, 2)).collect() == []
    data = np.frombuffer(b"123456789", np.uint8)
    assert token_records.crc32c(data, np.array([0]), np.array([9]))[0] == 0xE3069283
    long = np.arange(5000, dtype=np.uint8)
    whole = token_records.crc32c(long, [0, 0], [5000, 4999])
    assert whole[0] != whole[1]
    framed, sizes = token_records.frame(np.array([5, 6], np.uint32), np.array([0, 2]), np.array([1]), 2)
    with pytest.raises(ValueError):
        token_records._frames(framed[:22] + b"x" + framed[23:], np.array([0]))


def test_packing_covers_every_id_once():
    draw = np.random.default_rng(2)
    for lengths in ([], [0, 0], [1], [5000, 1, 1, 2047], draw.integers(0, 6000, 300)):
        lengths = np.array(lengths, np.int64)
        pieces = packing.pack_block(lengths)
        own, filled = {}, {}
        for d, start, n, s, offset in pieces:
            assert n > 0
            own.setdefault(d, []).append((start, n))
            filled.setdefault(s, []).append((offset, n))
        for parts, total in [(own.get(d, []), n) for d, n in enumerate(lengths)] + [(v, None) for v in filled.values()]:
            at = 0
            for a, n in sorted(parts):
                assert a == at
                at += n
            assert at == total if total is not None else at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_token_counts_equal_the_library(sent):
    rows = documents()
    got = sorted(map(tuple, token_counts.count_tokens(sent.createDataFrame(rows, SCHEMA), BPE, 100).collect()), key=repr)
    encode = Tokenizer.from_file(BPE)
    want = [(i, len((t or "").encode()), n := len(encode.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t, *_ in rows]
    assert got == sorted(want, key=repr)
    other = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t for _, t, *_ in rows]
    assert token_counts.TokenCounter(other).count(pa.array(texts)).tolist() == [len(Tokenizer.from_file(other).encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_language(sent):
    draw = random.Random(3)
    own = {"xx": ["ka", "ko", "kula", "kim"], "yy": ["zeß", "zön", "zuz", "zar"]}
    rows = [(n, " ".join(draw.choice(own[lang]) for _ in range(draw.randint(1, 30))), lang, 1, "x") for n in range(300) for lang in own]
    rows += [(None, "kula ka", None, 1, "x"), (900, None, "xx", 1, "x"), (901, "12 !", "xx", 1, "x"), (902, "", None, 1, "x")]
    docs = sent.createDataFrame(rows, SCHEMA)
    model = language_id.fit(docs.filter(~language_id.held_out()))
    got = language_id.identify(docs, model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 300)
    assert {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in got if r["doc_id"] in (900, 901, 902)} == {i: ("und", 0.0, True) for i in (900, 901, 902)}
    assert language_id.fit(docs.limit(0)) is None and {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_quotations(sent):
    rows = [(1, 0, "u", "Hello there.\nMore."), (1, 1, "a", "On Monday Ann wrote:\n> hello  there.\n> More.\nYes."), (1, 2, "u", "Other"), (1, 3, "u", ">> Hello there.\n> yes.\nThanks"), (1, 3, "u", None), (None, 0, "u", "> x"), (2, None, None, "")]
    got = quotations.link_quotations(sent.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    by = {(r["conv_id"], r["turn"], r["own_text"]): r for r in got}
    assert by[1, 1, "Yes."]["reply_to"] == 0 and by[1, 3, "Thanks"]["reply_to"] == 1 and by[1, 3, "Thanks"]["depth"] == 2 and by[1, 3, ""]["reply_to"] == 1
    assert [r["turn"] for r in got if r["conv_id"] == 1] == [0, 1, 3, 3, 2] and len(got) == len(rows)
    assert by[None, 0, ""]["n_linked"] == 0 and by[2, None, ""]["formatted"] == "<||>\n"


def test_near_duplicates_against_brute_force(sent):
    draw = random.Random(5)
    base = [f"w{n}" for n in range(120)]
    rows = documents()
    for n in range(150):  # a group of near copies around the threshold, beside copies
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(120)] = f"x{n}"
        rows.append((1000 + n, " ".join(w), "en", 1, "x"))
    sets, up = {}, {}
    for i, t, *_ in rows:
        if i is not None:
            w = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
            sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
            up[i] = i

    def root(x):
        return x if up[x] == x else root(up[x])

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(sent.createDataFrame(rows, SCHEMA), shingle=3, percent=85).collect()}
    assert {i: v for i, v in got.items() if i is not None} == {i: (len(sets[i]), root(i), root(i) == i) for i in ids}
    assert got[None][1:] == (None, True)
    assert near_duplicates(sent.createDataFrame([], SCHEMA)).collect() == []


def test_surrogates(sent):
    text = "Mrs. Anna Schmidt (anna.schmidt@mail.org, +1 (212) 555-0100) met Mr. Schmidt at 10.2.33.254; card 4111 1111 1111 1111. MRS. ignored. ANNA.SCHMIDT@mail.org"
    rows = [(1, text, "en", 1, "x"), (2, "Ms Schmidt", "en", 1, "x"), (3, "no data", None, 1, "x"), (None, "a@b.co", "en", 1, "x"), (4, None, "en", 1, "x"), (5, "", "en", 1, "x")]
    out = surrogates.replace_entities(sent.createDataFrame(rows, SCHEMA))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "lang", "doc", "th", "pii_entities"]
    assert "Schmidt" not in got[1] and "(212)" not in got[1] and "4111" not in got[1] and got[3] == "no data"
    new = surrogates.mentions(got[1])
    assert [m[2] for m in new] == [m[2] for m in surrogates.mentions(text)]
    family = [got[1][a:b] for a, b, kind, _ in new if kind == "family"]
    assert family[0] == family[1] == got[2].split()[1] and family[0][0].isupper() and got[4] is None and got[5] == ""
    mails = [got[1][a:b] for a, b, kind, _ in new if kind == "email"]
    assert mails[0].lower() == mails[1].lower() and mails[1].split("@")[0].isupper()
    card = re.sub(r"\D", "", next(got[1][a:b] for a, b, kind, _ in new if kind == "card"))
    assert surrogates._luhn(card[:-1]) == int(card[-1])
    # a small space: all different, none real
    many = sent.createDataFrame([("ip", f"1.1.1.{n}") for n in range(10)] + [("ip", f"1.1.2.{n}") for n in range(10)], "kind string, canon string")
    table = surrogates.draw_surrogates(many).collect()
    assert len({r["surrogate"] for r in table}) == 20 and not {r["surrogate"] for r in table} & {r["canon"] for r in table}


def test_templates(sent):
    items = sent.createDataFrame([(1, "A train leaves the town of Lyon with 12 wagons and meets Anna after 30 km on its way to Lyon again today"), (2, "too short"), (3, None), (None, "x " * 20)], "item_id long, text string")
    rows = [
        (1, "intro words. A train leaves the town of Nice with 99 wagons and meets Bob after 7 km on its way to Nice again today. end"),
        (2, "intro words. A train leaves the town of Nice with 99 wagons and meets Bob after 7 km on its way to Rome again today. end"),
        (3, "a TRAIN leaves, the town of lyon with 12 wagons and meets anna after 30 km on its way to lyon again today"),
        (4, "nothing to see here at all in this text of many plain words and so on and on"), (5, None), (6, ""), (None, "A train"), (1, "clean text under the same id"),
    ]
    got = templates.decontaminate(sent.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], SCHEMA), items).collect()
    flags = sorted((r["doc_id"], r["contaminated"]) for r in got if r["doc_id"] is not None)
    assert (3, True) in flags and (4, False) in flags and (5, False) in flags and (6, False) in flags and (1, True) in flags and (1, False) in flags
    assert len(got) == len(rows) and {r["contaminated"] for r in templates.decontaminate(sent.createDataFrame([(1, "x", "en", 1, "x")], SCHEMA), items.limit(0)).collect()} == {False}
    assert templates.decontaminate(sent.createDataFrame([], SCHEMA), items).collect() == []
