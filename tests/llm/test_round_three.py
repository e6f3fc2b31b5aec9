"""Lexical search, token alignment and personal data on edge rows, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import edge_texts, prose

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, top):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_all, l_all = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n_all) // l_all if l_all else 0
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if b[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return out


ITEMS = [(1, prose(1, 30)), (2, prose(2, 25) + " one TWO tHree"), (3, None), (4, "... !"), (5, "nothing of this kind exists zzzz"),
         (6, "日本語のテキスト 日本語のテキスト x9"), (7, prose(5, 3000)), (7, prose(3, 20)), (None, prose(4, 12))]


@pytest.mark.parametrize("shard,block,limit", [(1 << 19, 64, 1 << 20), (60, 3, 60), (400, 2, 1 << 20)])
def test_lexical_search(spark, docs, empty, monkeypatch, shard, block, limit):
    from metroframe.llm import lexical_search as m

    monkeypatch.setattr(m, "SHARD", shard)
    monkeypatch.setattr(m, "BLOCK", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = m.search(docs, items, top=3, item_terms_limit=limit).collect()
    assert Counter(map(tuple, rows)) == Counter(ranked(edge_texts(), ITEMS, 3))
    if shard == 1 << 19:
        assert m.search(empty, items).count() == 0
        assert m.search(docs, items.limit(0)).count() == 0


def test_lexical_search_skips_exactly(spark):
    from metroframe.llm import lexical_search as m

    # many alike documents with equal scores, where a wrong bound or a strict threshold would lose the smaller ids
    docs = [(k, prose(k % 40, 60)) for k in range(400)]
    items = [(k, prose(k, 15)) for k in range(12)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = m.item_terms(spark.createDataFrame(items, "item_id long, text string"))
    block = m.Items(asked.select("item", "terms").toArrow())
    vectors = m.vectors(table, block.vocabulary, "doc_id", "text")
    n, length, df = m.statistics(vectors, len(block.vocabulary))
    weight = m.weights(n, df)
    row = m.build_index(vectors.coalesce(1), block, n, length, weight).toArrow().combine_chunks().to_batches()[0]
    shard = m._Shard(row, 0)
    scored = 0
    for i, parts in shard.bounds(block, weight).items():
        wanted = np.zeros(len(weight), np.int64)
        own = block.terms[block.ptr[i]:block.ptr[i + 1]]
        wanted[own] = weight[own]
        for bound, blocks in parts:
            for b, at in zip(bound.tolist(), blocks.tolist(), strict=True):
                members = shard.members[shard.block_ptr[at]:shard.block_ptr[at + 1]]
                assert shard.scores(members, wanted).max() <= b  # no document scores above its block's bound
                scored += 1
    assert scored > 100
    rows = m.search(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter(map(tuple, rows)) == Counter(ranked(docs, items, 10))


def aligned(docs):
    """The contract's columns by sets of ends, and each row's groups."""
    import sentencepiece
    import tokenizers
    from metroframe.llm.token_alignment import byte_letters

    tok, sp = tokenizers.Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tok.encode_special_tokens = True
    letters = byte_letters()
    a_raw = {i: bytes(letters.get(c, 63) for c in t) for t, i in tok.get_vocab().items()}
    b_raw = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
             for i in range(sp.get_piece_size())]
    rows, count = [], Counter()
    for i, t in docs:
        a, b = (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        if b"".join(a_raw[x] for x in a) != b"".join(b_raw[x] for x in b) or b"".join(b_raw[x] for x in b) != (" " + (t or "")).encode():
            a = b = []
        ends_a, ends_b = np.cumsum([len(a_raw[x]) for x in a]).tolist(), np.cumsum([len(b_raw[x]) for x in b]).tolist()
        both, groups, links, p, q = set(ends_a) & set(ends_b), [([], [])], [], 0, 0
        for e in sorted({*ends_a, *ends_b}):
            links.append((a[p], b[q]))
            if ends_a[p] == e:
                groups[-1][0].append(a[p])
                p += 1
            if ends_b[q] == e:
                groups[-1][1].append(b[q])
                q += 1
            if e in both:
                groups.append(([], []))
        count.update(links)
        rows.append((i, len(a), len(b), groups[:-1], links))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for i, n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[z] == best[z[1]] for z in links), sum(count[z] for z in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
MORE = [(50, " "), (51, "  two  spaces\n\n<|endoftext|> <0x41> <s> é́ \x00 x"), (52, "\t\tdef f(x):\n        return 12345.678\n"),
        (53, "日本\U0001f600" * 400), (None, "same"), (None, "same"), (54, "<|endoftext|>")]


@pytest.mark.parametrize("frequent", [1 << 19, 50, 0])
def test_token_alignment(spark, docs, empty, frequent):
    from metroframe.llm.token_alignment import align_tokens

    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(MORE, "doc_id long, text string"))
    rows = align_tokens(table, BYTES, PIECES, frequent=frequent).select(*COLUMNS).collect()
    assert Counter(map(tuple, rows)) == Counter(aligned([*edge_texts(), *MORE]))
    if frequent:
        assert align_tokens(empty, BYTES, PIECES, frequent=frequent).count() == 0


def test_common_cuts():
    from metroframe.llm.token_alignment import common_cuts

    r = random.Random(5)
    for _ in range(300):
        n, last = r.randint(1, 60), r.randint(60, 90)
        a, b = (np.array(sorted({*r.sample(range(1, 60), r.randint(0, n - 1)), last})) for _ in range(2))
        got = common_cuts(a, b, np.array([0]), np.array([len(a) - 1]))
        assert a[got].tolist() == sorted((set(a) & set(b)) - {last})


PRIVATE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PRIVATE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), order, m.end()))
    return sorted(out)


PEOPLE = [
    "mail a.b_c%d@x-y.co.uk, or a@b.c_d@e.f.g@h.i", "\U0001f600 é 1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.1.1.000007.9", "4111 1111-1111 1111",
    "4111 1111 1111 1112", "+1 (132) 555-1352. +12345678 +123 456 789 012 345 6", "+1" + " " * 3000 + "x", "1" * 5000, "1.2.3" + ".4" * 4000,
    "x@" + "a." * 9000 + "z", "a.-" * 9000, "+49 30 1234567 79927398713 49927398716", "12 34567890128", "@@ a@ @b.c a@b a@b. a@b.c-", "1 2 3 4 5 6 7 8 9 0 1 2 3"]


def test_personal_data_base(spark, docs, empty):
    from metroframe.llm.personal_data import personal_data

    r = random.Random(9)
    texts = [*PEOPLE, *("".join(r.choice("ab1204.@+- ()_5") for _ in range(r.randint(5, 300))) for _ in range(300))]
    rows = [(1000 + k, t) for k, t in enumerate(texts)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [(x["doc_id"], tuple(map(tuple, x["base"]))) for x in personal_data(table).collect()]
    assert Counter(got) == Counter((i, tuple(base_spans(t))) for i, t in [*edge_texts(), *rows])
    assert personal_data(empty).count() == 0


def test_personal_data_many_matches(spark):
    from metroframe.llm.personal_data import base_spans as spans

    text = "é " + "a1@b.cd, " * 20_000
    row = spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).selectExpr(
        "size(base) n", "base[19999].start s", "base[19999].end e").first()
    assert tuple(row) == (20_000, 2 + 9 * 19_999, 2 + 9 * 19_999 + 7)


def test_personal_data_contexts(spark):
    from metroframe.llm.personal_data import KINDS, personal_data

    r = random.Random(2)

    def phone():
        return f"{r.randint(200, 999)}-555-{r.randint(1000, 9999)}"

    def ordinary():
        return f"{r.choice('abcdef')}{r.randint(10_000, 999_999)}"

    texts = []
    for k in range(80):
        texts.append(f"{prose(k, 20)} please call me at +1 {phone()} before noon and see part {ordinary()} of it")
    unseen = [f"555-{n}" for n in r.sample(range(1000, 9999), 12)]
    for k, u in enumerate(unseen):
        texts.append(f"{prose(100 + k, 20)} please call me at {u} before noon and see part {ordinary()} of it")
    # a name learned in the first round carries its own context to the second
    texts += [f"{prose(120 + k, 10)} desk line {u} is open" for k, u in enumerate(unseen)] + [prose(140, 10) + " desk line 0800-7777 is open"]
    clean = [f"{prose(200 + k, 30)} order {ordinary()} shipped" for k in range(40)]
    rows = list(enumerate([*texts, *clean]))
    out = {x["doc_id"]: x for x in personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    found = {i: {texts[i][s["start"]:s["end"]] for s in x["spans"] if KINDS[s["order"]] == "found_phone"}
             for i, x in out.items() if len(x["spans"]) > len(x["base"])}
    for k, u in enumerate(unseen):
        assert found[80 + k] == {u} and found[92 + k] == {u}
    assert found[104] == {"0800-7777"}
    assert set(found) == set(range(80, 105))  # no other string, and no clean text
    # one string repeated in many texts is one instance: its context earns no confidence
    same = [(k, f"{prose(k, 10)} ring +1 212-555-0000 now") for k in range(50)] + [(90, "ring 77-8888-99 now")]
    assert all(len(x["spans"]) == len(x["base"]) for x in personal_data(spark.createDataFrame(same, "doc_id long, text string")).collect())
