"""Codecs and parsers against their libraries, brute force and exact round trips; no Spark."""

import random
import re
from array import array

import numpy as np
import pytest

from quillspark.llm import flac, pii
from quillspark.llm.secrets import RULES, trigram_query
from quillspark.llm.simhash import fingerprint_bits


def _streams(payloads):
    data = np.frombuffer(b"".join(payloads), np.int8)
    return data, np.concatenate([[0], np.cumsum([len(p) for p in payloads])])


def _payloads():
    rng = np.random.default_rng(1)
    wave = (np.sin(np.arange(5000) / 7) * 90).astype(np.int8).tobytes()
    return [bytes(64), bytes(4096), wave, rng.integers(0, 256, 2048, dtype=np.uint8).tobytes(), (b"the quick brown fox " * 300)[:5952], wave[:64]]


def test_flac_round_trip_and_seek():
    data, offsets = _streams(_payloads())
    media, ends = flac.encode(data, offsets)
    pcm, at, blocks = flac.decode(media, ends)
    assert (pcm == data).all() and (at == offsets).all()
    assert [b[:, 1].sum() for b in blocks] == np.diff(offsets).tolist()
    one = media[ends[2] : ends[3]].tobytes()
    assert len(one) < 4000  # the wave compresses by its predictor
    assert flac.read_samples(one, 1000, 300) == data[offsets[2] + 1000 : offsets[2] + 1300].tobytes()
    assert flac.read_samples(one, 4990, 300) == data[offsets[2] + 4990 : offsets[3]].tobytes()


def test_flac_without_seek_table_and_with_damage():
    data, offsets = _streams(_payloads()[2:3])
    media, ends = flac.encode(data, offsets)
    raw = bytearray(media.tobytes())
    info = flac.read_info(bytes(raw))
    bare = raw[:4] + b"\x80" + raw[5:42] + raw[info.frames_at :]
    pcm, _, blocks = flac.decode(np.frombuffer(bytes(bare), np.uint8), np.array([0, len(bare)]))
    assert (pcm == data).all() and len(blocks[0]) == 5
    raw[info.frames_at + 200] ^= 4
    with pytest.raises(ValueError):
        flac.decode(np.frombuffer(bytes(raw), np.uint8), np.array([0, len(raw)]))


def test_fingerprints_by_hand():
    import xxhash

    for text in (b"", b"One", b"a b", b"A b c d e f a b c", b"x\x0by z  w\n"):
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.lower())
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        ones = [sum(xxhash.xxh64_intdigest(s, 42) >> i & 1 for s in shingles) for i in range(64)]
        want = sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))
        assert int(fingerprint_bits([text])[0]) == want


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "phone" and 9 <= len(digits) <= 15)
            if kind == "card" and 13 <= len(digits) <= 19:
                double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                ok = sum(d - 9 * (d > 9) for d in double) % 10 == 0
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_against_the_patterns():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("1234567890 .-+@a()é\n") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["a@b.c@d.e", "a@@b.c", "1.2.3.4.5.6.7.8", "card 4539148803436467.", "+1 (672) 555-0196", "a" * 50_000 + "@", "1" * 50_000]
    for text in texts:
        assert pii.base_spans(text) == _plain_spans(text), text[:80]


def test_field_finds_what_the_patterns_miss_and_viterbi_is_exact():
    crf = pii.train()
    text = "The 2353820953013749 was paid. In 2024 we sold 12 units of C++ (see 4.2)"
    data = np.frombuffer(text.encode(), np.uint8)
    (base, every), = pii.find_spans(data, np.array([0, len(data)]), crf)
    assert base == [] and every == [("account", 4, 20)]
    # whole chains, label by label, against the stretches that decode() cuts
    from itertools import product

    starts, ends, _ = pii.tokens(data, np.array([0, len(data)]))
    x = pii.shapes(data, starts, ends, np.zeros(len(starts), np.int64))[:5]
    score = sum(crf.emit[x[:, i]] for i in range(x.shape[1]))
    assert np.allclose(score, crf.scores(x), atol=1e-4)
    k = len(pii.LABELS)
    best = max(product(range(k), repeat=5), key=lambda p: crf.move[0, p[0]] + sum(score[i, p[i]] for i in range(5)) + sum(crf.move[p[i], p[i + 1]] for i in range(4)) + crf.move[p[-1], 0])
    assert crf.decode(score, np.zeros(5, np.int64)).tolist() == list(best)


def _spans(text, least=None):
    data = np.frombuffer(text.encode(), np.uint8)
    return [s[:3] for s in pii.find_spans(data, np.array([0, len(data)]), pii.train(), least)[0][1]]


def test_field_on_a_table_it_has_not_seen():
    """Precision and recall of all spans, and what looks like personal data and is none."""
    right = found = there = 0
    for line in pii.labelled_table(seed=2, draws=3):
        text, want = "", set()
        for part in re.split(r"(\[[A-Z]+ [^\]]*\])", line):
            m = re.fullmatch(r"\[([A-Z]+) ([^\]]*)\]", part)
            if m:
                want.add((len(text), len(text) + len(m[2])))
            text += m[2] if m else part
        got = {(a, b) for _, a, b in _spans(text)}
        right, found, there = right + len(got & want), found + len(got), there + len(want)
    print("precision", right / found, "recall", right / there)
    assert right >= 0.95 * found and right >= 0.95 * there
    for text in ("ISBN 9780306406157 here", "the time was 1732590000000 then", "1234567890123 rows", "pi is 3.14159265358979"):
        assert _spans(text, pii.CONFIDENT) == [], text
    assert _spans("call 020 7946 0958 now", pii.CONFIDENT) == [("phone", 5, 18)]
    assert _spans("IBAN DE89 3704 0044 0532 0130 00", pii.CONFIDENT) == [("iban", 5, 32)]


def test_odds_of_a_span_are_those_of_its_paths():
    crf = pii.train()
    score, label, line = np.random.default_rng(2).normal(size=(6, len(pii.LABELS))), np.array([0, 3, 4, 0, 0, 0]), np.zeros(6, np.int64)
    whole = lambda y: sum(score[i, y[i]] for i in range(6)) + crf.move[0, y[0]] + sum(crf.move[y[i], y[i + 1]] for i in range(5)) + crf.move[y[5], 0]
    assert np.isclose(crf.odds(score, label, line, 1, 3), whole(label) - whole([0] * 6), atol=1e-4)


def test_redaction_merges_overlaps():
    assert pii.redact("x +1 234 y", [("phone", 2, 8), ("card", 3, 8)]) == "x <PHONE> y"


def test_trigram_queries_hold_for_matches():
    samples = {"assign": "my Api_Key = abcdef1", "access": "AKIA" + "A" * 16, "pem": "-----BEGIN RSA PRIVATE KEY-----", "github": "ghp_" + "a" * 36, "google": "AIza" + "x" * 35, "jwt": "eyJab.eyJcd.ef", "slack": "xoxb-1234567890"}
    for rule in RULES:
        query = trigram_query(rule.pattern)
        if rule.kind == "hex":
            assert query == frozenset([frozenset()])
            continue
        text = samples[rule.kind]
        assert re.search(rule.pattern, text)
        assert any(all(g in text.lower() for g in group) for group in query) and frozenset() not in query


def test_transducer_equals_the_library():
    import public_tokenizers
    import sentencepiece

    from quillspark.llm.sentencepieces import transducer

    path = public_tokenizers.path("piece_bpe_32k.model")
    t, library = transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdeé \n▁日本ß.,'Th in\t😀  ") for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "  a  b ", "\n\n a", "Hello world, these are words. Größe übermäßig naïve", "<s> </s> <0x0A>", "x" * 20_000]
    for text in texts:
        ids = t.encode(text)
        assert list(array("I", ids)) == library.encode(text), text[:60]
        if "▁" not in text:
            assert t.decode(ids) == text


def test_transducer_keeps_nothing_after_a_task():
    import public_tokenizers

    from quillspark.llm.sentencepieces import transducer

    t = transducer(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(1, 12))) for _ in range(300))
    ids = t.encode(text)
    assert t.known and t.pairs
    t.forget()
    assert not t.known and not t.pairs
    assert t.encode(text) == ids


def test_a_task_gives_freed_memory_back():
    import subprocess
    import sys
    from pathlib import Path

    code = """
import re
from quillspark.llm.common import tidy
used = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
last = []
@tidy
def run(batches):
    for _ in batches:
        held = [bytes(1000) for _ in range(100_000)]
        last.append(held[-1])  # at the heap's end, so that free() alone returns nothing
        yield used()
before = used()
during = list(run(iter([0])))[0]
print(before, during, used())
"""
    got = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, check=True, timeout=60)
    before, during, after = map(int, got.stdout.split())
    assert during - before > 80 and after - before < 40


def test_chunk_encoder_equals_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    from quillspark.llm.token_files import encoder

    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = encoder(path), Tokenizer.from_file(path)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abÉé é.,'s12 日Σ\n\x1c\xa0 ́İtre") for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", "It's we'll café.", "<|endoftext|> x", "<|ENDOFTEXT|>", "a.b.. 12.5, don't\x85"]
    for text in texts:
        assert own.encode([text.encode()])[0] == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_block_max_index_is_exact(monkeypatch):
    """Against all cosines, with lists of both kinds, ties, empty rows, and an example left out."""
    from quillspark.llm import toxicity

    monkeypatch.setattr(toxicity, "LONG", 12)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        terms = np.sort(rng.choice(40, rng.integers(0, 6), replace=False)) if i % 9 else np.array([1, 5])
        w = rng.random(len(terms)) + 0.1 if i % 9 else np.ones(2)
        rows.append((terms, w / (np.sqrt((w * w).sum()) or 1)))
    index = toxicity.BlockMaxIndex(rows, 40)
    dense = np.zeros((300, 40))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    own = np.repeat(np.arange(300), [len(t) for t, _ in rows])
    terms, weights = np.concatenate([t for t, _ in rows]), np.concatenate([w for _, w in rows])
    for without in (None, np.arange(300)):
        for i, (ids, cosines) in enumerate(index.nearest(own, terms, weights, 300, 7, without)):
            every = np.round(dense @ dense[i], 12)
            if without is not None:
                every[i] = 0
            best = [j for j in np.lexsort((np.arange(300), -every)) if every[j] > 0][:7]
            assert ids.tolist() == best and np.allclose(cosines, every[best])


def test_block_max_index_of_long_lists_only():
    """No term asked for has a short list: the counts of hits are of no weights."""
    from quillspark.llm import toxicity

    one = np.ones(1)
    index = toxicity.BlockMaxIndex([(np.array([0]), one), (np.array([1]), one)], 2)
    (ids, cosines), (none, _) = index.nearest(np.zeros(1, np.int64), np.array([1]), one, 2, 3)
    assert ids.tolist() == [1] and cosines.tolist() == [1.0] and not len(none)
