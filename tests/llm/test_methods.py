"""The parts of the operators against plain versions, without Spark."""

import random
import re

import numpy as np
import pytest

from trawl.llm import decontaminate, html_text, language, mixing, near_dup, pii, substrings, tokens
from trawl.llm.common import WordHashes, lower_words, shingles
from trawl.llm.fingerprints import Fingerprint, edited, fingerprint, paragraphs
from .brute import edits_to_part, seats


def test_targets_stop_at_three_times_the_source():
    assert mixing.targets([10, 100, 1000], [5, 2, 1]) == [30.0, 300.0, 780.0]
    assert mixing.targets([100, 100], [1, 1]) == [100.0, 100.0]
    assert mixing.targets([0, 5], [5, 1]) == [0.0, 5.0] and mixing.targets([], []) == []


@pytest.mark.parametrize("seed", range(20))
def test_seats_go_to_the_highest_quotients(seed):
    rng = random.Random(seed)
    votes = [rng.choice([0, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 12))]
    count = rng.randint(0, 300)
    expected = seats(votes, count) if sum(votes) else [0] * len(votes)
    assert mixing.sainte_lague(votes, count) == expected


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_follow_the_patterns():
    rng = random.Random(3)
    letters = ("aB1234567890@@..-- +()%é_\n", "ab@.-a@b.c", "0123456789 -.", "+123 4567()")
    for i in range(20_000):
        text = "".join(rng.choice(letters[i % 4]) for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a@" * 50_000) == []


def test_trees_add_other_spellings_and_few_decoys():
    rng = random.Random(5)
    passages = [" ".join(rng.choices("the of and to in is that for was with at".split(), k=40)) for _ in range(900)]
    detector = pii.train(passages)
    found = false = 0
    for i in range(300):
        kind, cue, value = pii._example(rng)
        text = f"{passages[i]} {cue} {value} {passages[-1 - i]}"
        start = text.index(value, len(passages[i]))
        base = pii.base_spans(text)
        spans = [*base, *(s for s, _ in detector.added(text, base))]
        found += any(a <= start + 2 and b >= start + len(value) - 2 for _, a, b in spans)
        cue, value = pii._decoy(rng)
        text = f"{passages[i]} {cue} {value} {passages[-1 - i]}"
        false += bool(detector.added(text, pii.base_spans(text)))
    assert found >= 0.85 * 300 and false <= 0.03 * 300


def test_long_rows_of_numbers_are_proposed():
    numbers = [f"555-{i:03}-{4000 + i}" for i in range(200)]
    for gap in (" ", " / "):
        text = "call " + gap.join(numbers)
        found = set(pii.candidates(text))
        assert all(("phone", text.index(n), text.index(n) + len(n)) in found for n in numbers)
        assert all(end - start <= 64 for _, start, end in found)
    assert pii.candidates("1" * 200_000) == []
    assert len(pii.candidates("1 " * 20_000)) < 20 * 20_000
    local = "a.long-name" * 20
    assert ("email", 3, 3 + len(local) + 14) in pii.candidates(f"to {local} (at) home.org")
    assert ("email", 0, 18) in pii.candidates("me.at.home(at)x.de")
    pii.candidates("x" + ".at" * 50_000 + "(at)")


def test_numbers_in_long_rows_are_added():
    rng = random.Random(5)
    passages = [" ".join(rng.choices("the of and to in is that for was with at".split(), k=40)) for _ in range(900)]
    detector = pii.train(passages)
    numbers = [f"555-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}" for _ in range(8)]
    text = f"{passages[0]} phone {' '.join(numbers)} {passages[1]}"
    spans = [s for s, _ in detector.added(text, pii.base_spans(text))]
    covered = set().union(*(range(a, b) for _, a, b in spans)) if spans else set()
    assert len(covered) >= 0.5 * sum(map(len, numbers))


def test_band_keys_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(1)
    same = []
    for _ in range(60):
        base = rng.integers(0, 2**63, 900).astype(np.uint64)
        a, b = np.unique(base[:850]), np.unique(base[50:])  # 800 of 900: 0.89
        same.append((near_dup.band_keys(a) == near_dup.band_keys(b)).mean())
    assert abs(np.mean(same) - (8 / 9) ** 3) < 0.05


def test_shingles():
    hashes = WordHashes()
    of = lambda text: set(shingles(hashes.of(lower_words(text))).tolist())
    assert len(of("a b c d e f")) == 2 and of("A b\tc  D e\x0bf") == of("a b c d e f")
    assert len(of("a b")) == 1 and of("a b") != of("b a") and not of(" \n ")
    assert of("É a") != of("é a") and len(of("a b c")) == 1


def test_long_texts_are_cut_where_no_token_crosses(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library, ours = Tokenizer.from_file(path), tokens._bpe(open(path).read())
    monkeypatch.setattr(tokens, "LONG_CHARS", 8)
    rng = random.Random(2)
    parts = ["the", " of", "  ", "\n", "don't", "'ll", "é", "日本", "12", ".", "<|endoftext|>", "\t", "\x85", "x" * 30]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert sum(ours(tokens._safe_parts(text))) == len(library.encode(text, add_special_tokens=False))


def test_chunks_come_back_after_an_insertion():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400))
    plain = {u[0] for u in substrings.units(text)}
    moved = {u[0] for u in substrings.units("some new words " + text)}
    assert len(plain - moved) <= 4
    ends = substrings.chunk_ends(np.frombuffer(b"a" * 1000, np.uint8))
    assert ends[-1] == 1000 and max(np.diff([0, *ends])) <= substrings.MAX_CHUNK
    assert list(substrings.units("short")) == []


def test_fingerprints_are_sums():
    hashes = WordHashes()
    of = lambda text: fingerprint(paragraphs(text), hashes)
    a, b = of("one two three four\nfive six"), of("five six\none two three four")
    assert a == b and a.likeness(b) == 1.0 and a != of("five six")
    assert a - of("five six") == of("one two three four")
    assert Fingerprint.decoded(a.encoded()) == a and of("") == Fingerprint()
    old, new = "x y z\nsame line here\nsame line here", "same line here\nnew words come"
    assert edited(of(old), old, new, hashes) == of(new)
    words = [str(i) for i in range(3000)]
    half = of(" ".join(words)).likeness(of(" ".join(words[1500:] + [w + "x" for w in words[:1500]])))
    assert abs(half - 0.5) < 0.2


def test_lines_shared_with_the_nearest_page():
    assert html_text.shared_lines(list("abcxd"), list("acbd")) in ({0, 1, 4}, {0, 2, 4})
    assert html_text.shared_lines(["a"] * 3, ["a"] * 2) == {0, 1} and not html_text.shared_lines([], ["a"])
    page = "<div>Our site</div><p>{}</p><div>All rights</div><aside>own</aside>"
    one, two = (html_text.parse(page.format(x)) for x in ("first text", "second<br>text &amp; <b>m</b>ore"))
    assert html_text.main_text(two, one) == ("second text & more", 3)
    assert html_text.main_text(two, None)[0] == "Our site\n\nsecond text & more\n\nAll rights"
    marked = html_text.parse(
        "<head><title>t</title></head><nav>n</nav><main><h1>H</h1><p>a<p>b<div class='share x'>s</div></main>"
        "<footer>f</footer><script>if (a<b) '</p>'</script><!-- <p>c</p> --><form>q</form>"
    )
    assert html_text.main_text(marked, marked)[0] == "H\n\na\n\nb"


def test_repeated_lines_are_shared_as_long_as_possible(monkeypatch):
    assert html_text.shared_lines(list("xax"), list("ax")) == {1, 2}
    rng = random.Random(10)
    for bits in (html_text.ROW_BITS, 8):
        monkeypatch.setattr(html_text, "ROW_BITS", bits)
        for _ in range(400):
            a, b = (rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 14)) for _ in range(2))
            row = [0] * (len(b) + 1)
            for x in a:
                new = [0]
                for j, y in enumerate(b):
                    new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
                row = new
            found = [a[i] for i in sorted(html_text.shared_lines(a, b))]
            left = iter(b)
            assert len(found) == row[-1] and all(x in left for x in found)


def test_lines_of_a_main_are_aligned_and_articles_stay():
    page = "<main><p>Share this</p><p>{0} own text</p><p>Read our letter</p>{1}</main>"
    one, two = (html_text.parse(page.format(x, "")) for x in ("first, rather long", "second, just as long"))
    assert html_text.main_text(two, one) == ("second, just as long own text", 2)
    assert html_text.main_text(two, two)[0] == "Share this\n\nsecond, just as long own text\n\nRead our letter"
    one, two = (
        html_text.parse(page.format(x, "<article><p>Share this</p><p>story</p></article>"))
        for x in ("first, it is as long as all other lines", "second, and longer than the sum of others")
    )
    assert html_text.main_text(two, one)[0].split("\n\n")[1:] == ["Share this", "story"]


@pytest.mark.parametrize("start", [
    "<head><title>t</title><meta charset=x><body>", "<head><title>t</title>", "<body class='has-sidebar'>",
    "<html class='no-menu'><body id=share>", "<div id='page' class='with-sidebar page--menu'>",
    "<div class=widget><main class='social'>", "<select><p>",
])
@pytest.mark.parametrize("article", ["<article>", "<article class='post social'>"])
def test_no_page_is_lost_whole(start, article):
    page = html_text.parse(f"{start}{article}<p>text<div class='site-footer'>f</div></article>")
    assert html_text.main_text(page, None)[0] == "text"


def test_edit_distance_of_the_best_part():
    rng = random.Random(6)
    for _ in range(200):
        item = [rng.randint(1, 5) for _ in range(rng.randint(1, 9))]
        text = [rng.randint(1, 5) for _ in range(rng.randint(0, 15))]
        cost, first, stop = decontaminate.best_part(np.array(item, np.uint64), np.array(text, np.uint64))
        assert cost == edits_to_part(item, text)
        assert edits_to_part(item, text[first:stop]) == cost


def test_edited_items_are_found_and_others_not():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(800)]
    pick = lambda n: rng.choices(words, k=n)
    items = [(i, " ".join(pick(rng.randint(8, 60)))) for i in range(60)]
    block = decontaminate.Items(items)
    texts, expected = [], set()
    for t in range(240):
        i, text = rng.choice(items)
        part = text.split()
        for _ in range(decontaminate.allowed_edits(len(part))):
            at = rng.randrange(len(part))
            rng.choice([lambda: part.__setitem__(at, "new"), lambda: part.insert(at, "new"),
                        lambda: part.__delitem__(at) if len(part) > 1 else None])()
        texts.append(" ".join(pick(30) + part + pick(30)))
        expected.add((t, i))
    texts += [" ".join(pick(100)) for _ in range(200)]
    found = {(t, items[x][0]) for t, x, *_ in block.find(texts)}
    assert len(found & expected) >= 0.98 * len(expected)
    assert not {t for t, _ in found if t >= 240}


def test_words_follow_unicode():
    words = lambda t: [w.decode() for w in decontaminate._words(t)]
    assert words("Don’t—stop… état\u00a0naïve_2") == ["don", "t", "stop", "état", "naïve", "2"]
    assert words("日本語 and 語。ภาษาที่ 한국어 हिन्दी e\u0301t") == [
        *"日本語", "and", "語", *"ภาษา", "ที่", "한국어", "हिन्दी", "e\u0301t",
    ]
    rng = random.Random(11)
    for _ in range(2_000):
        text = "".join(rng.choice("aB9 _-éÀ×ß日。ท่\u0301한—’👍\u00a0\ud800\n") for _ in range(rng.randint(0, 20)))
        assert words_of_spans(text) == decontaminate._words(text)


def words_of_spans(text):
    lower = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    return [lower(m[0]).encode() for m in decontaminate._WORD.finditer(text)]


@pytest.mark.parametrize("item, before, after", [
    ("今天的天气非常好我们一起去公园散步", "他说", "然后回家。"),
    ("天气好", "今天", "啊"),
    ("วันนี้อากาศดีมาก", "เขาบอกว่า", "แล้วกลับบ้าน"),
    ("a short item", "he said “", "” and"),
    ("a short item", "this—", "—and"),
])
def test_items_are_found_in_any_script(item, before, after):
    block = decontaminate.Items([(1, item)])
    found = list(block.find([before + item + after, before + after]))
    assert [f[:3] for f in found] == [(0, 0, 0)]


def test_gradients_by_differences():
    rng = np.random.default_rng(8)
    net = language.Network.fresh(["a", "b", "c"], 4, rng)
    for direction in (net.ahead, net.behind):
        direction.table, direction.turn = direction.table.astype(float), direction.turn.astype(float)
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    codes = rng.integers(1, 30, (9, 5)).astype(np.uint8)
    real = np.ones((9, 5), np.float32)
    real[6:, 0] = 0
    answer = np.array([0, 1, 2, 1, 0])

    def loss():
        states = net.ahead.run(codes, real)[0], net.behind.run(codes[::-1], real[::-1])[0][::-1]
        p = net._softmax(*states)[:, answer, np.arange(5)]
        return -(np.log(p) * real).sum() / real.sum()

    for w, g in zip(net.weights(), net.gradients(codes, real, answer)):
        for _ in range(6):
            at = tuple(rng.integers(n) for n in w.shape)
            if w.shape[-1] == 256:
                at = (at[0], int(codes[0, 1]))
            old = w[at]
            w[at] = old + 1e-2
            up = loss()
            w[at] = old - 1e-2
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3


def test_states_agree_with_those_of_training():
    net = language.Network.fresh(["a", "b"], 6, np.random.default_rng(3))
    codes = np.random.default_rng(4).integers(0, 256, (20, 7)).astype(np.uint8)
    real = (codes > 20).astype(np.float32)
    assert np.allclose(net.ahead.states(codes, real), net.ahead.run(codes, real)[0], atol=1e-6)


def test_every_byte_is_pooled():
    net = language.Network.fresh(["a", "b"], 4, np.random.default_rng(9))
    texts = [bytes(range(1, 200)), b"x", b"y" * 70]
    pooled = language._pooled(net, texts)
    assert np.allclose(pooled.sum(axis=1), 1)
    single = np.concatenate([language._pooled(net, [t]) for t in texts])
    assert np.allclose(pooled, single, atol=1e-5)
