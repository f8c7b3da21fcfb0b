"""What the operators do to single texts, against plain versions of the same rules."""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parley.llm import arrays, bpe, decontaminate, langid, pii, quality, sites, syncmers, warc
from parley.llm.simhash import fingerprint
from parley.llm.trie import TrieJoin

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.lists(st.text(alphabet="aB é\t\n.ß1", max_size=40), max_size=8)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder.load(VOCABULARY)


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_words_are_those_between_white_space(texts):
    data, offsets = arrays.flat(pa.array(texts, pa.string()))
    starts, ends = arrays.words(data, offsets)
    whole = data.tobytes()
    assert [whole[a:b] for a, b in zip(starts, ends, strict=True)] == [w for t in texts for w in t.encode().split()]


def test_equal_words_have_equal_hashes():
    data = np.frombuffer(b"tree house tree", np.uint8)
    h = arrays.SpanHash(data)(np.array([0, 5, 11]), np.array([4, 10, 15]))
    assert h[0] == h[2] != h[1]


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a B c D e\tf  a b c d", "ÄÖ x y z w v"])
def test_fingerprint_by_its_definition(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_trie_join_finds_the_components_of_all_close_pairs():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), False)) for c in centres for _ in range(12)]
    values = np.unique(np.array(near, np.uint64))
    buckets = np.zeros(len(values), int)
    label = TrieJoin(buckets, values, 4).components()
    want = np.arange(len(values))
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            a, b = want[i], want[j]
            want[want == max(a, b)] = min(a, b)
    assert np.array_equal(label, want)
    assert np.array_equal(TrieJoin(np.arange(len(values)), values, 4).components(), np.arange(len(values)))


# Characters that Python's Unicode tables know; newer letters are left out, as the libraries differ about them.
ASSIGNED = st.text(alphabet=st.characters(exclude_categories=["Cn", "Cs"]), max_size=60)


@given(st.lists(ASSIGNED, max_size=4))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(encoder, texts):
    texts = [*texts, "Don't  STOP 12 ½ ΑΣ İx <|endoftext|>a<|startoftext|>", "\x1cq\x1d", "", "é ﬁ日本"]
    library = Tokenizer.from_file(VOCABULARY)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_forced_cuts_change_nothing(encoder):
    letters, cut, new_word = encoder.fragments(["zqxj", "tree"])
    assert cut.sum() > new_word.sum() == 2
    uncut = bpe.Encoder.load(VOCABULARY)
    uncut.inside[:] = True
    words = ["zqxj", "tree", "ñandúes", "schlüssel", "qzzq"]
    assert uncut.merge(words) == encoder.merge(words)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            odd = [int(d) for d in reversed(digits)]
            return 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m[0])]


@given(st.text(alphabet="a1.@-+ 4(2)%", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans_are_those_of_the_plain_patterns(text):
    for t in (text, text + " 4111 1111-1111 1111 x@y.z.", "1.2.3.4.5 +1 (017) 555-7713" + text):
        assert pii.base_spans(t) == plain_spans(t)


def test_checksums_and_context():
    iban = "GB82 WEST 1234 5698 7654 32"
    assert [s[:3] for s in pii.find(f"pay {iban} now") if not s[4]] == [("iban", 4, 4 + len(iban))]
    assert not [s for s in pii.find(f"pay {iban[:-1]}3 now") if s[0] == "iban"]
    two = "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32"
    assert [s[:3] for s in pii.find(two) if not s[4]] == [("iban", 0, 27), ("iban", 28, 55)]
    for number in ("TR330006100519786457841326", "HR1210010051863000160", "MT84MALT011000012345MTLCAST001S"):
        assert [s[:3] for s in pii.find(f"XX00 {number}.") if not s[4]] == [("iban", 5, 5 + len(number))]
    assert not [s for s in pii.find("DE89 3704 0044 0532 0130 00x DE00 XTR330006100519786457841326") if s[0] == "iban"]
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    told = f'the token = "{secret}" is ours'
    assert [s[:3] for s in pii.find(told)] == [("secret", 13, 53)] and secret not in pii.redact(told, pii.find(told))
    assert pii.find(f"commit {secret} of a branch") == pii.find("token " + "a1" * 20) == pii.find("token with-many-words-of-hyphens-in-it") == []
    assert [s[0] for s in pii.find("my SSN is 123-45-6789.")] == ["ssn"]
    assert pii.find("part 123-45-6789.") == []
    assert pii.score("call +1 555 123 4567", "phone", 5, 20) > pii.score("xxxx +1 555 123 4567", "phone", 5, 20)
    text = "mail a.b@c.de or 1.2.3.4"
    assert pii.redact(text, pii.find(text)) == "mail [EMAIL] or [IP]"


PAGE = """<html><head><title>t</title><script>var a="<p>x</p>";</script></head><body><nav><ul><li>Home<li>More</ul></nav>
<header>Site</header><div class="ad">Buy</div><article><header><h1>A &amp;  B</h1></header><p>One <b>two<br>three<p>four&nbsp;five</p>
<!-- no --><form>Name</form><div class="comments"><p>Nice</p></div></article><aside>Else</aside><footer>&copy;</footer></body></html>"""


def test_article_without_what_stands_around_it():
    assert sites.main_text(PAGE, set()) == "A & B One two three four five"
    assert sites.main_text("", set()) == "" and sites.main_text("plain < text", set()) == "plain < text"
    branch = next(sites.branch_of(b) for b in sites.blocks("<body><div class='x1'>same</div><p>own</p>") if b.text == "same")
    assert sites.main_text("<body><div class='x2'>same</div><p>own</p>", {branch}) == "own"


def test_unclosed_elements_do_not_hang_or_lose_text():
    assert sites.main_text("<article>" + "<div>" * 500 + "in" + "<p" * 1000, set()).startswith("in")
    assert sites.main_text("<article>a<script>b", set()) == "a"


def plain_phrases(text, known):
    n, i = 0, 0
    while i < len(text):
        size = 1
        while i + size < len(text) and text[i : i + size + 1] in known:
            size += 1
        n, i = n + 1, i + size
    return n


def test_phrases_are_greedy_longest_matches():
    texts = {"x": ["abab abba babb"], "y": ["cdcd dccd abcd"]}
    model = langid.fit(texts)
    coded = [langid.encode(t) for t in ["abbabbcd", "dcdcab ab", "zzz", "", "a\u4e2da"]]
    known = {k: "".join(map(chr, np.append(langid.encode(v[0]), 32))) for k, v in texts.items()}
    want = [[plain_phrases("".join(map(chr, c)), known[k]) for k in model.langs] for c in coded]
    assert langid.phrases(model, coded).tolist() == want


def test_language_of_texts_and_of_none():
    model = langid.fit({"en": ["the house and the tree are here " * 20], "de": ["das haus und der baum sind hier " * 20]})
    found = langid.predict(model, ["the tree and the house", "der baum und das haus", None, "", "12 !", "der baum " * 3000])
    assert [x[0] for x in found] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= x[1] <= 1 for x in found)
    assert langid.predict(langid.fit({}), ["abc"]) == [("und", 0.0)]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="content has-sidebar"><p>All of the text</p></div>', "All of the text"),
        ('<div class="post no-comments"><p>All of the text</p></div>', "All of the text"),
        ('<div id="social-history"><p>All of the text</p></div>', "All of the text"),
        ('<div class="search"><p>All of the text</p></div>', "All of the text"),
        ('<h1 class="main-title">Title</h1><div>A long text beside it</div>', "Title A long text beside it"),
        ("<article>teaser</article><div>A long text beside it</div>", "teaser A long text beside it"),
        ("<p>" + "\u0130" * 60 + "</p><script>var a;</script><p>after</p>", "\u0130" * 60 + " after"),
        ("<p>one</p><SCRIPT>x</ScRiPt><p>two</p>", "one two"),
        ('<div class="related-posts">r</div><div class="cookie-notice">c</div><div class="ad-box">a</div><p>own</p>', "own"),
        ('<article>own<div class="ad">a</div><section class="comments">c</section></article><div class="site-footer">f</div>', "own"),
        ('<article></article><div class="ad">a</div>', ""),
        ("<nav>only links</nav>", ""),
    ],
)
def test_names_alone_do_not_take_a_pages_text(page, text):
    assert sites.main_text(f"<html><body>{page}</body></html>", set()) == text


WRITTEN = {
    "zh": "今天天气很好我们去公园散步然后回家吃饭孩子们在学校学习数学和语文",
    "ja": "今日は天気がとても良いので公園を散歩してから家に帰ってご飯を食べました子供たちは学校で数学を勉強します",
    "ko": "오늘은 날씨가 아주 좋아서 공원을 산책하고 집에 돌아와 밥을 먹었습니다 아이들은 학교에서 수학을 공부합니다",
    "el": "σήμερα ο καιρός είναι πολύ καλός και πήγαμε στο πάρκο για περίπατο και μετά γυρίσαμε στο σπίτι",
    "ru": "сегодня очень хорошая погода мы пошли гулять в парк а потом вернулись домой обедать дети учатся в школе",
    "en": "today the weather is very good so we took a walk in the park and then went home to eat the children study",
}
UNSEEN = {"zh": "我们回家学习数学", "ja": "公園で勉強しました", "ko": "학교에서 밥을 먹었습니다", "el": "πήγαμε στο σπίτι και είναι καλός", "ru": "дети пошли домой гулять", "en": "the children went home"}


def test_languages_of_many_scripts_in_one_model():
    model = langid.fit({k: [v, v] for k, v in WRITTEN.items()})
    assert [found[0] for found in langid.predict(model, list(UNSEEN.values()))] == list(UNSEEN)
    assert langid.encode("Ä-中, 1b").tobytes().decode() == "ä 中 b" and langid.encode("").size == 0


def test_equal_languages_are_told_by_name():
    model = langid.fit({"b": ["one text"], "a": ["one text"]})
    assert [found[0] for found in langid.predict(model, ["one", "zzz", "\u4e2d"])] == ["a", "a", "a"]


def plain_syncmers(text):
    def h(s):
        return syncmers._hashes(np.array([ord(c) + 1 for c in s], np.uint64), slice(None), len(s))[0]

    out = []
    for i in range(len(text) - syncmers.K + 1):
        inner = [h(text[i + j : i + j + syncmers.S]) for j in range(syncmers.K - syncmers.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((int(h(text[i : i + syncmers.K])), i))
    return out


def test_anchors_are_closed_syncmers_and_need_no_context():
    text = "The quick brown fox jumps over the lazy dog, again and again."
    hashes, places = syncmers.anchors(text)
    assert list(zip(hashes.tolist(), places.tolist(), strict=True)) == plain_syncmers(text)
    moved = syncmers.anchors("Lead. " + text)
    assert set(hashes.tolist()) <= set(moved[0].tolist())


def test_likeness_of_fingerprints():
    a = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    b = " ".join(f"other{i * 7907 % 1000}" for i in range(400))
    prints = [syncmers.sketch(t) for t in (a, b, syncmers.edited(a, b), "", "short")]
    assert syncmers.likeness(prints[0], prints[0]) == 1.0 == syncmers.likeness(prints[3], prints[3])
    assert syncmers.likeness(prints[0], prints[1]) < 0.1 and syncmers.likeness(prints[0], prints[3]) == 0.0
    assert 0.3 < syncmers.likeness(prints[0], prints[2]) < 0.7
    assert len(prints[4][0]) == 1
    for p in prints:
        back = syncmers.read(syncmers.written(p))
        assert all(np.array_equal(x, y) for x, y in zip(p, back, strict=True))


def plain_likeness(a, b):
    """Pairs of neighbouring anchors with their distance, counted in plain dictionaries."""
    both = []
    for text in (a, b):
        found = plain_syncmers(text) or ([(text, 0)] if text else [])
        pairs = Counter()
        for i, (h, at) in enumerate(found):
            h_before, at_before = found[i - 1] if i else (None, 0)
            pairs[h_before, at - at_before, h] += 1
        both.append(pairs)
    if not both[0] or not both[1]:
        return float(len(both[0]) == len(both[1]))
    return 2 * (both[0] & both[1]).total() / (both[0].total() + both[1].total())


@given(st.text(alphabet="ab é", max_size=80), st.text(alphabet="ab é", max_size=80), st.integers(0, 80))
@settings(max_examples=60, deadline=None)
def test_likeness_is_that_of_plain_counts(a, b, at):
    for x, y in ((a, b), (a, a[:at] + b + a[at:]), (a, syncmers.edited(a, b)), (a * 3, a)):
        assert syncmers.likeness(syncmers.sketch(x), syncmers.sketch(y)) == plain_likeness(x, y)


def test_inserted_sentences_cost_only_what_is_around_them():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 9, 3000)]
    text = " ".join(words)[:20_000]
    for count in (1, 2, 3, 5):
        new = text
        for i in range(count):
            at = 1000 + i * 4000
            new = new[:at] + " ".join(rng.permutation(words)[:25].tolist()) + new[at:]
        assert syncmers.likeness(syncmers.sketch(text), syncmers.sketch(new)) >= 0.95
    halves = syncmers.edited(text, "other words " * 2000)
    assert abs(syncmers.likeness(syncmers.sketch(text), syncmers.sketch(halves)) - 0.5) < 0.05


def _archive(n=5):
    return [warc.record(i, f"http://x/{i}", "response", b"body %d " % i * 9, None, 0, "S") for i in range(n)]


def test_salvage_reads_on_after_damage():
    members = _archive()
    members[2] = members[2][:30] + b"\xff\xff\xff" + members[2][33:]
    data = b"junk" + b"".join(members)
    found = list(warc.salvage(data))
    assert [f[0] for f in found] == ["gap", "record", "record", "gap", "record", "record"]
    assert found[0][1:3] == (0, 4)
    start = 4 + len(members[0]) + len(members[1])
    assert found[3][1:3] == (start, start + len(members[2]))
    assert [f[3]["warc-record-id"] for f in found if f[3]] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]


def test_salvage_of_plain_records_cut_ends_and_nothing():
    plain = b"".join(map(gzip.decompress, _archive(3)))
    assert len(list(warc.salvage(plain))) == 3
    cut = list(warc.salvage(plain[:-3]))
    assert [f[0] for f in cut] == ["record", "record", "gap"] and cut[-1][2] == len(plain) - 3
    mixed = _archive(2)[0] + plain
    assert [f[0] for f in warc.salvage(mixed)] == ["record"] * 4
    assert list(warc.salvage(b"")) == []
    broken = plain.replace(b"body 1 ", b"bodY 1 ", 1)
    assert [f[0] for f in warc.salvage(broken)] == ["record", "gap", "record"]
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def plain_salvage(data):
    """Sound members and records of an archive, everything tried at every place."""
    out, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        try:
            whole = member.decompress(data[at:]) if data[at:].startswith(warc.GZIP) else data[at:]
            end = len(data) - len(member.unused_data) if member.eof else None
        except zlib.error:
            whole, end = b"", None
        head, _, rest = whole.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        named = all(b":" in line for line in lines[1:])
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
        length = fields.get(b"content-length", b"")
        n = int(length) if length.isdigit() else 0
        sound = re.fullmatch(rb"WARC/\d+\.\d+", lines[0]) and named and length.isdigit() and rest[n : n + 4] == b"\r\n\r\n"
        block = fields.get(b"warc-block-digest", b"").decode("latin-1")
        sound = sound and (not block.startswith("sha1:") or block[5:] == warc.digest(rest[:n]))
        if sound and data[at:].startswith(b"WARC/"):
            end = at + len(head) + 8 + n
        if sound and end:
            out.append((at, end, rest[:n]))
            at = end
        else:
            at += 1
    return out


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_salvage_finds_what_a_try_at_every_place_finds(data):
    members = [m if data.draw(st.booleans()) else gzip.decompress(m) for m in _archive(4)]
    whole = bytearray(b"".join(members))
    for _ in range(data.draw(st.integers(0, 4))):
        at = data.draw(st.integers(0, len(whole) - 1))
        kind = data.draw(st.sampled_from(["flip", "cut", "insert"]))
        whole[at : at + (kind != "insert")] = {"flip": bytes([whole[at] ^ 0x41]), "cut": b"", "insert": b"WARC/1.1\r\n\x1f\x8b\x08"}[kind]
    found = list(warc.salvage(bytes(whole)))
    assert [(f[1], f[2], f[4]) for f in found if f[0] == "record"] == plain_salvage(bytes(whole))
    ends = [0, *(f[2] for f in found)]
    assert [f[1] for f in found] == ends[:-1] and ends[-1] == len(whole)


def test_salvage_time_grows_with_the_bytes():
    members = b"".join(_archive(200))
    reads = []
    for times in (10, 80):
        data = members * times
        source = warc._Source(pa.BufferReader(data))
        taken = 0
        real = source.read

        def read(at, n, real=real):
            nonlocal taken
            out = real(at, n)
            taken += len(out)
            return out

        source.read = read
        at = 0
        while at < source.size:
            at = warc._member(source, at)[1]
        reads.append(taken / len(data))
    assert reads[1] < 1.1 * reads[0]


def test_paths_of_object_stores():
    assert warc.uri("s3a://b/x") == "s3://b/x" and warc.uri("file:/tmp/x") == "file:///tmp/x" and warc.uri("hdfs://h/x") == "hdfs://h/x"


def test_hinge_model_learns_and_calibrates():
    rng = np.random.default_rng(3)
    good = [" ".join(rng.choice(["calm", "river", "stone", "light"], 20)) + "." for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW!!", "$$$"], 20)) for _ in range(60)]
    rows = list(quality.indicators(pa.array([*good, *bad])))
    model = quality.fit(rows, np.repeat([1, 0], 60), 0.8)
    scores = [model.score(f) for f in quality.indicators(pa.array(["calm river light stone.", "NOW!! $$$ BUY!! NOW!!", "", None, " \n"]))]
    assert scores[0] > 0.7 and scores[1] < 0.3 and all(0 <= s <= 1 for s in scores) and scores[2] == scores[3] == 0.0
    assert quality.fit(rows[:3], np.ones(3, int), 1.0).score(rows[0]) == 1.0
    assert quality.fit([], np.zeros(0, int), 0.5).score(rows[0]) == 0.5


def test_dual_descent_reaches_the_least_loss():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 6, False)) for _ in range(40)]
    values = [np.ones(6) for _ in rows]
    labels = np.array([int(r[0] < 3) for r in rows])
    weights, bias = quality.descend(rows, values, labels)
    sign = np.where(labels > 0, 1, -1)

    def loss(w, b):
        cost = 0.5 / np.array([np.mean(labels == 0), np.mean(labels == 1)])[labels]
        margin = sign * np.array([w[r].sum() + b for r in rows])
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - margin)).sum()

    least = loss(weights, bias)
    for _ in range(200):
        other = weights.copy()
        other[:30] += rng.normal(0, 0.05, 30)
        assert loss(other, bias) > least - 0.05


def test_common_subsequence():
    def plain(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        return t[-1, -1]

    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(0, 5, rng.integers(0, 30))
        assert decontaminate.common_subsequence(a, b) == plain(a, b)


def test_answers_of_items():
    items = decontaminate.read_items([(1, "What is it? Answer: a tall tree"), (2, "First part. Second part here."), (3, None), (4, " ")])
    assert [i.key for i in items] == [1, 2] and [len(i.answer) for i in items] == [3, 3]
    assert hashlib.sha1(b"").digest()
