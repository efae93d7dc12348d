"""Operators on single texts, against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import WORDS, edge_rows, sentence
from tripmart.llm import bpe, language, mixing, pieces, pii, quality_rules, rangecoder, shingles, tokenfile, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
BLANK = r"[^\x20\x09-\x0D]+"


def by_id(rows):
    return sorted((r.asDict() for r in rows), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, str(r)))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_pieces_and_merges_equal_the_library(tokenizer):
    vocab = bpe.vocabulary(PATH)
    texts = [
        "", " ", "  a", "a \n\n b", "don't we'll 's 'S \"'s", "x'd'd", "\r\n\t x", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b",
        "漢字かな 😀😀 　 ²½ 12a", "é" * 50, "z" * 700, "=" * 90 + " " * 45, *[t or "" for _, t, *_ in edge_rows()],
    ]
    lexicon = bpe.Lexicon.compile([b" ta", b"ta", b" mita", b"kaso", b"don", b"=" * 40], vocab)
    lexicon = bpe.Lexicon.of_buffer(lexicon.to_bytes())
    flat, places = bpe.encode_cut(bpe.cut(texts, vocab.special_text), vocab, lexicon)
    other, bounds = tokenfile.piece_encoder(PATH).encode(texts)
    for text, a, b, c, d in zip(texts, places[:-1], places[1:], bounds[:-1], bounds[1:], strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert flat[a:b].tolist() == ids == other[c:d].tolist()
        assert bpe.decode(flat[a:b], vocab) == tokenizer.decode(ids, skip_special_tokens=False)
    broken = np.array([bpe.vocabulary(PATH).byte_ids[0xC3], bpe.vocabulary(PATH).byte_ids[0x20]])
    assert bpe.decode(broken, vocab) == tokenizer.decode(broken.tolist(), skip_special_tokens=False)


def thue_morse(size):
    """A string and its complement: equal under every polynomial hash modulo a power of two, from 1,024 letters on."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


class Counted:
    """The library, and how many texts it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_library_gets_many_pieces_at_once(tokenizer):
    encoder = tokenfile.PieceEncoder(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    words = [f"{a}{b}{c}" for a in WORDS for b in WORDS for c in ("", "q", "é")]
    blanks = ["  ", " \n", "\n\n \t", "\u00a0", " \u00a0 ", "\u2003", " 12", " '", "'s", " 's", "<|endoftext|>", " <|", "endoftext|>", " \U0001f600", ""]
    texts = [" " + " ".join(words), "".join(a + b + "x" for a in blanks for b in blanks), "".join(blanks[::-1])]
    for given, most in ((texts[:1], 10), (texts, 200), (texts, 0)):
        counted.given = 0
        ids, places = encoder.encode(given)
        assert counted.given <= most
        for text, a, b in zip(given, places[:-1], places[1:], strict=True):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_joined_pieces_are_told_where_merges_cross(tokenizer):
    encoder = tokenfile.PieceEncoder(PATH)
    pieces = [b" the", b"re", b" is", b" not", b"h", b"ing"]
    ids, at, own = encoder._joined(b"".join(pieces), np.cumsum([len(p) for p in pieces]))
    assert own.tolist() == [False, False, True, False, False, False]
    assert ids[at[2] : at[3]].tolist() == tokenizer.encode(" is", add_special_tokens=False).ids


def test_settled_pieces_are_cut_once(tokenizer):
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    kinds = {(1, 2, 2): pieces.LETTER, (2, 1, 2): pieces.NUMBER, (2, 2, 2): pieces.SPACE, (2, 2, 1): pieces.OTHER}
    settled = [chr(c) for c in range(0x800)]
    assert [kinds[tuple(len(cut(k + c)) for k in "a1!")] for c in settled] == pieces._classes()[:0x800].tolist()
    encoder = tokenfile.PieceEncoder(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    texts = [" ".join(WORDS * 40), "".join(settled), " ".join(settled), "a".join(settled), " " + "1 ".join(settled)]
    ids, places = encoder.encode(texts)
    assert counted.given == 0
    for text, a, b in zip(texts, places[:-1], places[1:], strict=True):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_equal_pieces_are_equal_bytes(tokenizer, size):
    one, two = thue_morse(size)
    vocab = bpe.vocabulary(PATH)
    lexicon = bpe.Lexicon.of_buffer(bpe.Lexicon.compile([b"ab"], vocab).to_bytes())
    encoder = tokenfile.PieceEncoder(PATH)
    for blocks in ([[one, two]], [[one], [two]]):
        for texts in blocks:
            for flat, places in (encoder.encode(texts), bpe.encode_cut(bpe.cut(texts, vocab.special_text), vocab, lexicon)):
                for text, a, b in zip(texts, places[:-1], places[1:], strict=True):
                    assert flat[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    sentences = [f"we saw {word} there today" for word in (one, two)]
    first, second = shingles.shingle_sets(sentences)
    assert len(first) == len(second) == 2 and not set(first.tolist()) & set(second.tolist())


def test_automaton_is_minimal_and_numbers_its_words():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"a", b"stop", b"stops"})
    automaton = bpe.Automaton.build(words)
    data = np.frombuffer(b"".join([*words, b"ta", b"zz", b"tapsx"]), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in [*words, b"ta", b"zz", b"tapsx"]])
    starts = np.concatenate([[0], ends[:-1]])
    assert automaton.indexes(data, starts, ends).tolist() == [*range(len(words)), -1, -1, -1]
    # The root, after s, after st, after t, before p, before a last s, and the end.
    assert len(automaton.final) == 7


def test_encode_decode_on_edge_cases(edge_docs, no_docs, tokenizer):
    name = bpe.fit(edge_docs, PATH)
    found = by_id(bpe.encode(edge_docs, PATH, name).collect())
    expected = []
    for doc_id, text, *_ in edge_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        expected.append({"doc_id": doc_id, "n_tokens": len(ids), "ids": bytearray(raw), "decoded": text or ""})
    assert found == sorted(expected, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, str(r)))
    assert bpe.encode(no_docs, PATH, bpe.fit(no_docs, PATH)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 127, 128, 300, 70_000])
def test_range_coder_round_trip(size):
    random = np.random.default_rng(size)
    ids = np.minimum(random.zipf(1.3, size), 50_000).astype(np.int32)
    blocks = [ids[k : k + rangecoder.BLOCK_IDS] for k in range(0, size, rangecoder.BLOCK_IDS)] + [ids[:1], ids[::-1][:500]]
    coded = rangecoder.encode_blocks(blocks, 50_257)
    for back, block in zip(rangecoder.decode_blocks(coded), blocks, strict=True):
        assert np.array_equal(back, block)
    # Each block can be read alone, and a damaged one is told.
    assert np.array_equal(rangecoder.decode_blocks(coded[-1:])[0], blocks[-1])
    damaged = bytearray(coded[0])
    damaged[-1] ^= 1
    with pytest.raises(rangecoder.BlockError):
        rangecoder.decode_blocks([bytes(damaged)])


def test_range_coder_learns():
    ids = np.tile(np.arange(1000, 1050), 1300)[:65_000].astype(np.int32)
    assert len(rangecoder.encode_blocks([ids], 50_257)[0]) < len(ids) * 2 / 6


def test_range_coder_tables_hold_the_ids_of_a_block():
    random = np.random.default_rng(3)
    few = (random.integers(0, 16, rangecoder.BLOCK_IDS) * 3000).astype(np.int32)
    every = random.permutation(50_257).astype(np.int32)
    (coded,) = rangecoder.encode_blocks([few], 50_257)
    # Four bits an id, two digits and a count for each lane, and learning; with tables of all ids it was 41,770 bytes.
    assert len(coded) < len(few) // 2 + 6000
    other = rangecoder.encode_blocks([few[:5000] // 3000], 300)
    payloads = [coded, *rangecoder.encode_blocks([every, few[:1]], 50_257), *other]
    for back, block in zip(rangecoder.decode_blocks(payloads), [few, every, few[:1], few[:5000] // 3000], strict=True):
        assert np.array_equal(back, block)


def test_crc_of_parts():
    parts = [b"abc" * 40, b"", b"x", b"longer part" * 999]
    assert tokenfile.crc_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("block_ids", [64, rangecoder.BLOCK_IDS])
def test_token_files(spark, edge_docs, no_docs, tokenizer, tmp_path, monkeypatch, block_ids):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", block_ids)
    path = str(tmp_path / "files")
    tokenfile.write(edge_docs, path, PATH)
    found = sorted(tokenfile.index(spark, path).collect(), key=lambda r: r["start"])
    rows = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (doc_id, text, *_) in zip(found, rows, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    tokenfile.write(no_docs, str(tmp_path / "none"), PATH)
    assert tokenfile.index(spark, str(tmp_path / "none")).collect() == []


def plain_counts(text):
    text = text or ""
    words = re.findall(BLANK, text)
    lines = [line for line in text.split("\n") if re.search(BLANK, line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = {}, set()
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_quality_counts(edge_docs, no_docs):
    rows = by_id(quality_rules.judged(edge_docs).collect())
    assert len(rows) == len(edge_rows())
    texts = sorted(((i, t) for i, t, *_ in edge_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    for row, (doc_id, text) in zip(rows, texts, strict=True):
        counts = plain_counts(text)
        assert row["doc_id"] == doc_id and {k: row[k] for k in counts} == counts
        failed = counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])
    assert quality_rules.judged(no_docs).collect() == []
    counted = quality_rules.with_counts(edge_docs)
    assert counted.columns == [*edge_docs.columns, "counts_"]


def test_quality_order_by_gain(spark):
    rules = [quality_rules.Rule(n, None) for n in "abcd"]
    names = lambda shares, costs: "".join(r.name for r in quality_rules.by_gain(rules, shares, costs, 0.01))
    assert names([0.1, 0.4, 0.0, 0.1], [0.01] * 4) == "badc"
    assert names([0.4, 0.1, 0.0, 0.1], [0.64, 0.01, -1.0, 0.02]) == "bdac"
    assert names([0.2, 0.2, 0.2, 0.2], [0.011, 0.012, 0.009, -0.5]) == "abcd"
    docs = spark.range(600).selectExpr("id AS doc_id", "repeat(concat('wört ', id, ' '), 400) AS text")
    slow = quality_rules.Rule("slow", lambda t: F.length(F.regexp_replace(t, r"(\p{L}+) (?=\d)", "")) > 0)
    fast = quality_rules.Rule("fast", lambda t: F.length(t) > 0)
    never = quality_rules.Rule("never", lambda t: F.length(t) < 0)
    for _ in range(2):
        assert quality_rules.measured_order(docs, "text", [slow, never, fast]) == [fast, slow, never]
    assert quality_rules.measured_order(docs.limit(0), "text", [slow, fast]) == [slow, fast]
    assert quality_rules.sampled(docs).count() == 600 and 0 < quality_rules.sampled(docs, 100).count() < 250


def test_quality_order_does_not_change_the_verdict(edge_docs):
    counted = quality_rules.with_counts(edge_docs).select("doc_id", "text", "counts_.*")
    text = F.coalesce("text", F.lit(""))
    verdicts = [
        sorted(map(str, counted.select("doc_id", quality_rules.cascade(order, text).isNull().alias("kept")).collect()))
        for order in (quality_rules.RULES, quality_rules.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def plain_targets(sizes):
    """Shares by weight, the excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return target


def test_mixing(edge_docs, no_docs):
    planned, names = mixing.planned_copies(edge_docs)
    rows = planned.collect()
    sizes = {}
    for _, text, _, source, *_ in edge_rows():
        sizes[source] = sizes.get(source, 0) + len(re.findall(BLANK, text or ""))
    expected = plain_targets(sizes)
    for row in rows:
        size, copies = row[names["size"]], row[names["copies"]]
        assert size == len(re.findall(BLANK, row["text"] or ""))
        assert row[names["source_size"]] == sizes[row["source"]]
        assert row[names["target"]] == pytest.approx(expected[row["source"]])
        rate = expected[row["source"]] / max(sizes[row["source"]], 1)
        assert 0 <= copies <= 2 and copies in (int(rate), int(rate) + 1)
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r[names["copies"]] for r in rows)
    assert mixing.mix(no_docs).collect() == []


def test_mixing_meets_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(4000)], "doc_id long, text string, source string")
    planned, names = mixing.planned_copies(docs)
    taken = planned.groupBy("source").agg(
        F.sum(F.col(names["size"]) * F.col(names["copies"])).alias("taken"), F.max(names["target"]).alias("target")
    )
    for row in taken.collect():
        assert row["taken"] == pytest.approx(row["target"], rel=0.05)


def plain_base(text):
    text, out = text or "", {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out["ip"] = [m.span() for m in ips if all(len(d := p.lstrip("0")) <= 3 and int(d or 0) <= 255 for p in m[0].split("."))]

    def luhn(digits):
        return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0

    cards = [(m.span(), re.sub(r"[^0-9]", "", m[0])) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)]
    out["card"] = [s for s, d in cards if 16 <= len(d) <= 19 and luhn(d)]
    phones = [(m.span(), re.sub(r"[^0-9]", "", m[0])) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)]
    out["phone"] = [s for s, d in phones if 8 <= len(d) <= 15]
    return [(k, *s) for k, spans in out.items() for s in spans]


PRIVATE = [
    "a@b.c a.b@c.d.e@f.gh x@y @z.de a@b..c .@a.b- %%@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.02.3.255 99999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 6011000990139424123 12", "+49 (0)30 1234567. +1 +12 3 +1234567890123456",
    "iban DE89 3704 0044 0532 0130 00 DE00 3704 0044 0532 0130 00 ssn 123-45-6789 and 123-45-6789" + " " * 60 + "987-65-4321",
    "a" * 3000 + "@" + "b" * 3000, "1" * 5000 + ".1.1.1", "+1" + "(" * 4000, "é😀 me@x.org", "1." * 3000, "@" * 3000,
]


def test_base_spans_equal_the_patterns():
    for text in [*PRIVATE, *(t for _, t, *_ in edge_rows())]:
        spans = pii.spans_of(text)
        assert [s[:3] for s in spans if s[3]] == plain_base(text)
    kinds = [s[0] for s in pii.spans_of(PRIVATE[4])]
    assert kinds.count("iban") == 1 and kinds.count("identity") == 2
    assert pii.masked("call +1 (212) 555-0199 or a@b.cd") == "call <PHONE> or <EMAIL>"
    assert pii.masked(None) is None and pii.masked("") == ""


@pytest.mark.parametrize("after", ["", " BIC: COBADEFFXXX", " I am", " 2024", " A1 B2 C3", " DE00 3704 0044 0532 0130 00"])
def test_account_numbers_before_other_words(after):
    number = "DE89 3704 0044 0532 0130 00"
    assert pii.masked(f"IBAN {number}{after}") == f"IBAN <IBAN>{after}"
    assert pii.masked(f"{number} {number}{after}") == f"<IBAN> <IBAN>{after}"
    assert pii.masked(f"AB12 CDEF {number}{after}") == f"AB12 CDEF <IBAN>{after}"


def test_spans_in_spark(edge_docs, no_docs):
    found = pii.with_spans(edge_docs, "found_").collect()
    for row in found:
        assert [(s["kind"], s["start"], s["end"]) for s in row["found_"]] == [s[:3] for s in pii.spans_of(row["text"])]
    masked = pii.mask(edge_docs)
    assert masked.columns == edge_docs.columns and masked.count() == len(found)
    assert pii.mask(no_docs).collect() == [] and pii.with_spans(no_docs, "x").collect() == []


def test_folding_and_matching():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "foo$": 4.0, "scum": 3.0}, ["no idiot"], (-3.0, 1.0, 1.0))
    key = lexicon.key()

    def words(text):
        return [toxicity.fold(text)[a:b] for a, b, _ in toxicity.matches(toxicity.fold(text), key)]

    assert words("IDIOT 1d10t іdіоt idi​ots") == ["idiot"] * 4
    assert words("foo food xfoo foo") == ["foo", "foo"]
    assert words("he is no idiot, idiot") == ["idiot"]
    assert words("") == [] and toxicity.evidence(None, key) == (0.0, 0.0)


def plain_matches(folded, weights, exceptions):
    """(start, end, weight) of the longest term at each word start, found by looking at every place."""
    starts = [i for i, c in enumerate(folded) if not (i and folded[i - 1].isalpha())]
    closed = [i for i in range(len(folded) + 1) if i == len(folded) or not folded[i].isalpha()]
    spared = [(i, i + len(p)) for i in starts for p in exceptions if folded.startswith(p, i) and i + len(p) in closed]
    found = []
    for start in starts:
        terms = {}
        for term, weight in weights.items():
            word = term.removesuffix("$")
            end = start + len(word)
            if folded.startswith(word, start) and (term == word or end in closed):
                terms[end, term != word] = weight
        if terms:
            (end, _), weight = max(terms.items())
            if not any(a <= start and end <= b for a, b in spared):
                found.append((start, end, weight))
    return found


def test_matches_equal_a_plain_search():
    pick = np.random.default_rng(5)
    for _ in range(300):
        letters = lambda n: "".join(pick.choice(list("ab"), n))
        weights = {letters(n) + pick.choice(["", "$"]): float(n) for n in pick.integers(1, 5, 6)}
        exceptions = {letters(2) + " " + letters(3), letters(3)}
        folded = "".join(pick.choice(list("abab  -"), pick.integers(0, 60)))
        key = toxicity.Lexicon(weights, exceptions).key()
        assert sorted(toxicity.matches(folded, key)) == plain_matches(folded, weights, exceptions)


def test_lexicon_prefers_long_forms(spark):
    chosen = toxicity._chosen(
        {"path": (20, 3.0), "pathe": (20, 6.0), "pathet": (19, 6.0), "pathet$": (19, 6.0), "stem": (30, 5.0),
         "stema": (12, 5.0), "stemb": (11, 5.0), "scum$": (9, 4.0)}
    )
    assert chosen == {"pathet": 6.0, "stem": 5.0, "scum$": 4.0}
    both = toxicity._curve(np.array([[0.0, 0], [1, 2], [2, 1], [0, 0]]), np.array([0.0, 1, 1, 0]))
    assert both[1] >= 0 and both[2] >= 0
    rows = [(i, f"{sentence(i, 40)} pathetisch" if i % 3 == 0 else f"{sentence(i, 40)} path pathologie") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, int(i % 3 == 0)) for i in range(300)] + [(i, 1 - int(i % 3 == 0)) for i in range(30)]
    lexicon = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(lexicon.weights) == {"pathetis"}
    asked = spark.createDataFrame([(1, "the path to the pathology lab"), (2, "pathetisch")], "doc_id long, text string")
    low, high = (r["s"] for r in toxicity.score(asked, lexicon, "s").orderBy("doc_id").collect())
    assert low < toxicity.THRESHOLD <= high


def test_toxicity_learns(spark, edge_docs, no_docs):
    def make(i):
        bad = i % 3 == 0
        text = sentence(i, 40 + i % 60) + (" grobian" + WORDS[i % 5] if bad else "")
        return i, text, int(bad)

    rows = [make(i) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000, None), (None, 1)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels)
    scored = {r["doc_id"]: r["s"] for r in toxicity.score(docs, lexicon, "s").collect()}
    held = [(scored[i] >= toxicity.THRESHOLD) == bool(y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100 and np.mean(held) > 0.97
    edge = toxicity.score(edge_docs, lexicon, "s").collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r["s"] <= 1 for r in edge)
    empty = toxicity.fit(no_docs, labels)
    assert toxicity.score(no_docs, empty, "s").collect() == []
    assert {r["s"] for r in toxicity.score(edge_docs, empty, "s").collect()} == {0.0}


def test_language_learns(spark, edge_docs, no_docs):
    sounds = {"aa": ("tak", "rok", "lum"), "bb": ("élo", "uni", "ço"), "cc": ("schi", "über", "wen")}

    def make(i):
        lang = sorted(sounds)[i % 3]
        pick = np.random.default_rng(i)
        return i, " ".join("".join(pick.choice(sounds[lang], 2)) for _ in range(8 + i % 30)), lang

    rows = [make(i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    found = {r["doc_id"]: r["p"] for r in language.identify(docs, model, "p").collect()}
    held = [found[i]["lang"] == lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 80 and np.mean(held) > 0.97
    edge = language.identify(edge_docs, model, "p").collect()
    for row in edge:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["p"]["lang"] == "und") == (not letters) and 0 <= row["p"]["score"] <= 1
    none = language.fit(no_docs)
    assert language.identify(no_docs, none, "p").collect() == []
    assert {r["p"]["lang"] for r in language.identify(edge_docs, none, "p").collect()} == {"und"}


def test_kernel_counts_shared_grams():
    found = language.presence(["abc", "abc", "xyz", "", "12 !"])
    assert found[0].sum() == len({"a", "b", "c", " ", "ab", "bc", "c ", "abc", "bc "})
    k = language.kernel(found, found)
    assert k[0, 1] == pytest.approx(1) and k[0, 2] < 0.5 and found[3].sum() == found[4].sum() == 0


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
