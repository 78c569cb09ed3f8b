"""Pieces of the operators against plain restatements of their rules."""

from __future__ import annotations

import gzip
import io
import random
import re

import numpy as np
import pytest
import xxhash

from daylake.llm import decontaminate, html, langid, lm, packing, pii, pitmanyor, quality, secrets, simhash, warc
from daylake.llm.golay import nearby_indices
from daylake.llm.queries import tokenizer_path

RNG = random.Random(5)


def test_words_one_bit_apart_share_a_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 4_000)
    here = nearby_indices(words)
    for bit in range(23):
        there = nearby_indices(words ^ (1 << bit))
        assert ((here[:, :, None] == there[:, None, :]) & (here[:, :, None] >= 0)).any(axis=(1, 2)).all()


def test_fingerprints_within_three_bits_share_a_key():
    for _ in range(400):
        one = RNG.getrandbits(64)
        other = one
        for bit in RNG.sample(range(64), 3):
            other ^= 1 << bit
        keys = [set(simhash.golay_keys(np.array([x], np.uint64))[0].tolist()) for x in (one, other)]
        assert keys[0] & keys[1]


def plain_fingerprint(text: str) -> int:
    low = "".join(c.lower() if c.isascii() else c for c in text)
    words = [w for w in re.split(r"[ \t-\r]+", low) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "  \n", "One", "one TWO", "a b c", "É b\x0bc d a b c É", "x " * 70_000, "  a b c d"])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_a_bucket_gives_a_forest_of_its_links():
    base = RNG.getrandbits(64)
    group = np.unique(np.array([base ^ (1 << RNG.randrange(64)) for _ in range(40)] + [RNG.getrandbits(64) for _ in range(5)], np.uint64))
    links = simhash._links_of(group, 3)
    assert len(links) < len(group) and all((int(a) ^ int(b)).bit_count() <= 3 for a, b in links)

    def parts(pairs):
        label = {int(x): int(x) for x in group}
        for _ in group:
            for a, b in pairs:
                label[int(a)] = label[int(b)] = min(label[int(a)], label[int(b)])
        return label

    every = [(a, b) for a in group for b in group if (int(a) ^ int(b)).bit_count() <= 3]
    assert parts(links) == parts(every)


def test_myers_is_the_least_distance_to_a_substring():
    def plain(pattern, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(pattern, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    for _ in range(200):
        pattern = "".join(RNG.choices("abc", k=RNG.randint(1, 90)))
        text = "".join(RNG.choices("abc", k=RNG.randint(0, 60)))
        assert decontaminate.myers(pattern, text, len(pattern))[0] == plain(pattern, text)


def test_edited_items_are_found_and_fragments_are_not():
    item = decontaminate.normalised("Which of the quiet rivers near the old mill turns its wheel when the long winter rains have come and gone again?")
    matcher = decontaminate.Matcher([(7, item)])
    edited = item.replace("rivers", "rivrs").replace("winter", "wimter")
    found = matcher.matches("some words before " + edited + " and after")
    assert [(m[0], m[1]) for m in found] == [(7, 2)]
    assert matcher.matches("before " + item[:60] + " after") == []
    assert decontaminate.Matcher([]).matches("text") == [] and matcher.matches("") == []


def test_matches_are_those_of_a_search_without_pieces():
    found = 0
    for _ in range(600):
        letters = RNG.choice(["ab", "abcde ", "abcdefghijklmnop "])
        items = [(n, "".join(RNG.choices(letters, k=RNG.randint(1, 70)))) for n in range(4)]
        edited = list(RNG.choice(items)[1])
        for _ in range(RNG.randint(0, 9)):
            at = RNG.randint(0, len(edited))
            edited[at : at + RNG.randint(0, 1)] = RNG.choices(letters, k=RNG.randint(0, 1))
        text = "".join(RNG.choices(letters, k=RNG.randint(0, 40)) + edited + RNG.choices(letters, k=RNG.randint(0, 40)))
        rate = RNG.choice([0.02, 0.08, 0.12, 0.25])
        wanted = {}
        for n, item in items:
            near = decontaminate.myers(item, text, decontaminate.budget(item, rate)) if text else None
            if near:
                wanted[n] = near[0]
        got = decontaminate.Matcher(items, rate).matches(text)
        assert {m[0]: m[1] for m in got} == wanted and len(got) == len(wanted)
        found += len(wanted)
    assert found > 500


PLAIN_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_pii(text):
    out = []
    for kind, pattern in PLAIN_PII.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], list(PLAIN_PII).index(s[2])))


def test_base_personal_data_is_what_the_patterns_say():
    parts = ["a.b@c.de", "@x.y", "a@b", "b.c@d@e.fg", "1.2.3.4", "256.1.1.1", "0001.02.3.4.5.6.7", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (569) 555-6633", "+44 20 ", "+", " ", "é", "12", "-", ".", "x_y%z@q-r.st.uv."]
    for _ in range(1_500):
        text = "".join(RNG.choices(parts, k=RNG.randint(1, 9)))
        assert pii.base_spans(text) == plain_pii(text), text


def test_added_personal_data_needs_its_checksum_or_context():
    def kinds(text):
        return [k for *_, k in pii.added_spans(text, pii.base_spans(text))]

    assert kinds("account DE89370400440532013000 closed") == ["iban"]
    assert kinds("account DE88370400440532013000 closed") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("call +1 (569) 555-6633 4111111111111111 card") == ["phone", "card"]
    assert pii.mask("to a@b.co or ssn 123-45-6789.") == "to [EMAIL] or ssn [SSN]."


def test_long_runs_take_time_in_proportion():
    for run in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "@" * 100_000, "A" * 300_000):
        pii.all_spans(run)
        secrets.base_matches(run)
        quality.counts_of(run)
        html.main_text("<" + run)
        html.main_text("<p>" * 20_000 + "<a '" * 5_000)


def test_base_secrets_are_what_the_patterns_say():
    def plain(text):
        out = []
        low = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        out += [(*m.span(), "assign") for m in re.finditer(low, text) if len(m[2]) >= 8]
        out += [(*m.span(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        out += [(*m.span(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
        return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))

    parts = ["password", "Token", "API_KEY", "apikey", "=", ": ", '"', "'", " ", "hunter22", "s3cr3t/+x==", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "é", "x"]
    for _ in range(1_500):
        text = "".join(RNG.choices(parts, k=RNG.randint(1, 9)))
        assert [s for s, _ in secrets.base_matches(text)] == plain(text), text


def test_random_strings_differ_from_identifiers():
    counts = {label: np.zeros(secrets.STATES**2, np.int64) for label in secrets.COUNTED}
    for _ in range(300):
        value = "".join(RNG.choices(secrets.ALPHABET[:64], k=30))
        counts["random"] += np.bincount(secrets.steps(value), minlength=secrets.STATES**2)
        word = "".join(RNG.choices(["get", "user", "account", "settings", "list", "order", "by", "value"], k=5))
        counts["ordinary"] += np.bincount(secrets.steps(word), minlength=secrets.STATES**2)
    ratios = secrets.log_ratios(counts)
    text = "key q7Zf0LxW2mNc8VbT5yRk1JhGd3Ps and getaccountorderlistsettings here"
    found = secrets.added_spans(text, [], ratios)
    assert [text[a:b] for a, b, _ in found] == ["q7Zf0LxW2mNc8VbT5yRk1JhGd3Ps"]


def test_statistics_of_a_text():
    words = "a b c a b c d e f g # | é"
    text = f"{words}\n\n{words}\nlast line"
    stats = dict(zip(quality.COUNTS, quality.counts_of(text), strict=True))
    split = text.split()
    windows = [tuple(split[i : i + 3]) for i in range(len(split) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    assert stats["n_words"] == len(split) and stats["word_chars"] == sum(map(len, split))
    assert stats["n_symbols"] == 4 and stats["n_dup_lines"] == 1 and stats["n_repeat_words"] == len(covered)
    assert set(quality.counts_of(None)) == {0}


def test_rules_are_learned_and_nothing_without_bad_rows():
    import pandas as pd

    rng = np.random.default_rng(3)
    table = pd.DataFrame({name: rng.random(900) for name in quality.FEATURES})
    bad = ((table.symbols_per_word > 0.7) & (table.upper_share > 0.5)).to_numpy()
    rules = quality.learn_rules(table, bad)
    covered = np.zeros(len(table), bool)
    for rule in rules:
        covered |= quality._covers(rule, table)
    assert (covered == bad).mean() > 0.97
    assert quality.learn_rules(table, np.zeros(len(table), bool)) == []


def test_word_ids_are_those_of_the_whole_text():
    encode = packing.Encoder(tokenizer_path())
    texts = ["Don't stop; it's 12,5 x².", "a ́b é É! ***", "<|endoftext|> x\x1cy\x85z w", "", "\n", "İI ΣΣ. “q”.", "treè*** foo.bar, (x)."]
    got = encode([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == whole


def test_tables_follow_the_exact_conditional():
    c, d, alpha = 6, 0.5, 1.7
    weights = np.exp(pitmanyor.stirling(d)[c, 1 : c + 1]) * alpha ** np.arange(1, c + 1)
    draws = pitmanyor.draw_tables(np.full(40_000, c), np.full(40_000, alpha), d, np.random.default_rng(0))
    assert np.allclose(np.bincount(draws, minlength=c + 1)[1:] / 40_000, weights / weights.sum(), atol=0.01)
    many = pitmanyor.draw_tables(np.array([0, 1, 5_000]), np.array([1.0, 1.0, 3.0]), d, np.random.default_rng(0))
    assert many[0] == 0 and many[1] == 1 and 1 <= many[2] <= 5_000


def test_spelling_chances_sum_to_one():
    codes, _ = lm.contexts([b"thing", b"then", b"other", b"on"])
    seen, n = np.unique(codes, return_counts=True)
    before = seen >> 18
    pick = before == ord("t")
    rows = lm.seat_below(seen[pick], n[pick], np.full(256, 1 / 256), 0)
    assert all(abs(row.sum() - 1) < 1e-6 for level, _, row in rows if level)


def test_languages_of_unseen_texts():
    en = ["the house and the garden of the old man", "she was there with the others and they were happy", "this is that which the people have"]
    de = ["das haus und der garten des alten mannes", "sie war dort mit den anderen und sie waren froh", "dies ist das was die leute haben"]
    model = langid.fit_model([(t, "de") for t in de] + [(t, "en") for t in en])
    assert [p[0] for p in model.predict(["und der mann ist dort", "and the man is there", None, "123 !?", ""])] == ["de", "en", "und", "und", "und"]
    assert model.predict(["日本語の文章"])[0][1] == 0
    assert langid.fit_model([]).predict(["text"]) == [("und", 0.0)]


def test_records_come_back_and_damage_is_seen():
    payloads = [b"", b"x" * 200_000, "é".encode() * 10, bytes(range(256)) * 40]
    data = b"".join(warc.member(warc.record(i, f"http://a/ {i}", p)) for i, p in enumerate(payloads))
    data += warc.member(warc.record(9, None, payloads[1], refers_to=1, revisit=True))
    assert len(gzip.decompress(data)) > 200_000
    found = list(warc.read_records(io.BytesIO(data)))
    assert [r.http()[1] for r in found[:4]] == payloads
    assert found[4].kind == "revisit" and warc.page_of(found[4].headers["warc-refers-to"]) == 1
    with pytest.raises(warc.Damaged):
        list(warc.read_records(io.BytesIO(data[:-20])))
    wrong = warc.member(warc.record(1, None, b"abc").replace(b"abc", b"abd"))
    with pytest.raises(warc.Damaged):
        list(warc.read_records(io.BytesIO(wrong)))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("plain &amp; simple", "plain & simple"),
        ("<body><nav><a href=1>m</a></nav><article><h1>T</h1><p>a<b>b</b>\n c&#233;<br>d<p>Be.</article><footer>f</footer>", "T ab cé d Be."),
        ("<body><div class='post'><p>Long enough text of a post, here.</p><div id=comments><p>Nice!</p></div></div><div class='sidebar'><p>ad</p></div>", "Long enough text of a post, here."),
        ("<main><p>One text that is long.<script>var a='</p>';</script></p><form>f</form><!-- c --></main><aside>s</aside>", "One text that is long."),
        ("<p>a<script>x", "a"),
        ("<article><p>x</p><!-- open", "x"),
    ],
)
def test_main_text(source, text):
    assert html.main_text(source) == text


def _read_word_by_word(words, lp):
    """log10 probability of one text, with the restaurants of the text as plain counters."""
    (d1, d2), (s1, s2) = lm.TEXT_DISCOUNTS, lm.TEXT_STRENGTHS
    upper, lower, out, before = {}, {}, 0.0, None
    for word in words:
        held = sum(upper.values())
        chance = (max(upper.get(word, 0) - d1, 0) + (s1 + d1 * len(upper)) * 10 ** lp[word]) / (s1 + held)
        room = lower.setdefault(before, {})
        held = sum(room.values())
        out += np.log10((max(room.get(word, 0) - d2, 0) + (s2 + d2 * len(room)) * chance) / (s2 + held))
        if word not in room:
            upper[word] = upper.get(word, 0) + 1
        room[word] = room.get(word, 0) + 1
        before = word
    return out


def test_texts_are_scored_given_their_own_past():
    rng = np.random.default_rng(3)
    lp = np.log10(rng.dirichlet(np.ones(9)))
    texts = [rng.integers(0, 9, size) for size in (1, 2, 40, 1, 300, 7)]
    texts += [np.zeros(50, np.int64), np.tile([4, 5], 20)]
    got = lm.chained(np.concatenate(texts), np.array([len(t) for t in texts]), lp)
    assert got == pytest.approx([_read_word_by_word(t.tolist(), lp) for t in texts])
    # What may follow a text has chances that sum to one.
    for text in texts:
        longer = [np.append(text, word) for word in range(9)]
        scores = lm.chained(np.concatenate(longer), np.full(9, len(text) + 1), lp)
        alone = lm.chained(text, np.array([len(text)]), lp)[0]
        assert (10 ** (scores - alone)).sum() == pytest.approx(1)


def test_texts_with_words_too_rare_for_a_float_are_scored():
    got = lm.chained(np.array([0, 0, 1]), np.array([3]), np.array([-4_000.0, -0.1]))
    assert np.isfinite(got).all() and -4_010 < got[0] < -4_000


def test_parts_of_texts_cover_each_once():
    sizes = np.array([5, 1, 1, 90, 3, 3, 3])
    parts = list(lm._in_parts(sizes, 6))
    assert [i for a, b in parts for i in range(a, b)] == list(range(7))
    assert all(sizes[a:b].sum() <= 6 or b == a + 1 for a, b in parts)


@pytest.mark.parametrize("name, by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoders_give_the_ids_of_whole_texts(name, by_words):
    from tokenizers import Tokenizer

    encode, plain = packing.Encoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    assert encode.by_words is by_words
    rng = random.Random(5)
    texts = ["", " ", "Two  Words.\n", "Caf\u00e9! \u00dcber, (na\u00efve) it's 3.5%", "<|endoftext|> x", "the<|startoftext|>end", "<|EndOfText|>", "<|endoftext", "<|endoftext|>" * 3]
    texts += ["".join(rng.choices("aB\u00e9\u00df.,!?;'-# \n\t0 9", k=rng.randrange(60))) for _ in range(200)]
    for text, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_words_of_letters_go_straight_to_the_model(monkeypatch):
    from tokenizers import Tokenizer

    encode, plain = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    steps, others = encode._of_any, []
    monkeypatch.setattr(encode, "_of_any", lambda words: others.extend(words) or steps(words))
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]]
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(40)) for _ in range(100)]
    texts += ["Été ÉTÉ, naïve straße", "a×b c÷d σς o'er 3x"]
    for text, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    # Beside those of the probe, only words with capitals beyond ASCII, signs, digits and other scripts take all steps.
    assert {word.decode() for word in others} == {"ÉtÉ", "a×b", "c÷d", "σς", "o'er", "3x"}
