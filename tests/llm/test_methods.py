"""Round trips, held-out accuracy, and the parts of the methods on their own."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

from profilerank.llm import audio, bpe, graph, html, language, quality, queries, sharding, urls

SF = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_is_the_librarys(spark):
    library = Tokenizer.from_file(TOKENIZER)
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 200").fetchall()]
    texts += ["", "a<|endoftext|>b <|endoftext|> c", "   \n\n x  ", "it's I'LL 'tis", "\ud7ff  \x1c \x85 z", "<|endoftext", "a" * 5000, "😀é" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    encoded = bpe.encode(docs, TOKENIZER)
    ids = {r["doc_id"]: r["token_ids"] for r in encoded.collect()}
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[i] for i in range(len(texts))] == wanted
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, TOKENIZER).collect()}
    assert [back[i] for i in range(len(texts))] == [library.decode(w, skip_special_tokens=False) for w in wanted]
    for row in bpe.round_trip(docs, TOKENIZER).collect():
        own = wanted[row["doc_id"]]
        assert row["n_tokens"] == len(own)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_language_by_hand(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' WHERE doc_id < 300").fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)

    def count(text):
        out = Counter()
        for word in regex.findall(r"\p{L}+", text.lower()):
            padded = f" {word} "
            out.update(word)
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
        return out

    def top(counts):
        # A two-character n-gram's number is larger than a letter's, a three-character one's larger still.
        number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))[:language.PROFILE]]

    total = defaultdict(Counter)
    for _, text, lang in rows:
        total[lang] += count(text)
    profiles = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in total.items()}
    found = {r["doc_id"]: r for r in language.predict(docs, language.learn(docs)).collect()}
    for doc, text, _ in rows:
        own = top(count(text))
        size = language.PROFILE
        far = {lang: sum(abs(i - p[g]) if g in p else size for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert found[doc]["lang_pred"] == best
        assert abs(found[doc]["score"] - (1 - far[best] / (size * len(own)))) < 1e-12


def test_language_held_out(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = [r for r in queries.op2_language(spark, SF).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows) and len(rows) > 200
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_shards_by_hand(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaab") if i % 9 else None, None if i % 50 == 0 else "x" * (i % 7)) for i in range(500)] + [(3, "a", "q")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    found = sharding.interleave(docs, 7, "s").collect()
    by = defaultdict(list)
    for doc, source, text in rows:
        raw = (text or "").encode()
        key = int(hashlib.md5(f"s:{doc}".encode()).hexdigest()[:15], 16)
        by[source].append((key, doc, zlib.crc32(raw), len(raw) + 8))
    order = []
    for source, own in by.items():
        for i, (key, doc, crc, size) in enumerate(sorted(own)):
            order.append(((i + 0.5) / len(own), source is not None, source or "", key, doc, crc, size))
    order.sort()
    wanted, slots = [], Counter()
    for pos, (*_, doc, crc, size) in enumerate(order):
        shard = pos * 7 // len(order)
        wanted.append((doc, size, crc, "rows", shard, slots[shard], None))
        slots[shard] += 1
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert max(slots.values()) - min(slots.values()) <= 1
    # Every shard has the mixture: as many rows of a source as its share, give or take one.
    source_of = {doc: s for doc, s, _ in rows}
    for source, own in by.items():
        counts = Counter(r["shard"] for r in found if source_of[r["doc_id"]] == source)
        assert all(abs(counts[s] - len(own) / 7) < 2 for s in range(7))


def test_url_trie():
    rng = random.Random(5)
    for _ in range(300):
        rules = [(rng.choice(("allow", "block")), ".".join(rng.choice("abc") for _ in range(rng.randint(1, 3))),
                  "".join(rng.choice(("/", "x", "y")) for _ in range(rng.randint(0, 4)))) for _ in range(6)]
        rules = [(v, h, p if p[:1] in ("", "/") else "/" + p) for v, h, p in rules]
        trie = urls.UrlTrie(rules)
        for _ in range(20):
            host = ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
            path = "/" + "".join(rng.choice("/xy") for _ in range(rng.randint(0, 5))) if rng.random() < 0.9 else ""
            fits = [(h.count(".") + 1, len(p), v == "block", h + p, v) for v, h, p in rules
                    if f".{host}".endswith(f".{h}") and path.startswith(p)]
            wanted = max(fits)[3:] if fits else None
            assert trie.match(host.encode(), path.encode()) == wanted
    assert urls.split_url(b"x://A.Org?q#f") == (b"a.org", b"") and urls.split_url(b"no") == urls.split_url(None) == (b"", b"")
    assert urls.split_url("http://\u00c4B.de/P\u00c4/?x".encode()) == ("\u00c4b.de".encode(), "/P\u00c4/".encode())


def test_pages(spark):
    def page(i, body):
        return (f"<html><head><title>t</title><style>x</style></head><body><nav><ul><li>m{i}<li>n</ul></nav><header>site {i}</header>"
                f"<div class='cookie-notice'>cookies</div><div id=x{i}><h1>Head {i}</h1>{body}<p>Shared line</p></div>"
                f"<form><p>mail</p></form><aside>side</aside><div class='comments'><p>reader {i}</p></div><footer>f</footer></body></html>")

    bodies = ["<p>One <b>bold</b>&nbsp;&amp;\n text<p>Two", "<ul><li>a<li>b</ul>", "<p>x</p><table><tr><td>c<td>d</table>", "", "<p>x<br>y<!-- no --></p><script>var a='</p>';</script>"]
    rows = [(i, f"http://h.org/{i}", page(i, b)) for i, b in enumerate(bodies)]
    rows += [(10, "http://k.org/1", "<article><header><h1>T</h1></header><p>x</p><section id=comments><article class=comment>no</article></section></article>menu"),
             (11, None, None), (12, "http://one.org", "<p>alone</p><p>alone</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    text = {r["page_id"]: r["text"] for r in html.extract_text(pages).collect()}
    assert text[0] == "Head 0\n\nOne bold & text\n\nTwo"
    assert text[1] == "Head 1\n\na\n\nb" and text[2] == "Head 2\n\nx\n\nc\n\nd" and text[3] == "Head 3" and text[4] == "Head 4\n\nx y"
    assert text[10] == "T\n\nx" and text[11] == "" and text[12] == "alone\n\nalone"


def test_wrapper_alignment():
    def of(source):
        return html.describe(html.parse(source))

    made = html.merge(of("<h1>a</h1><p>x</p><p>y</p>"), of("<h1>b</h1><ul><li>1</ul><p>x</p>"))
    head, items, text = made[2]
    assert head[1] == "h1" and head[2][0][2] is None  # titles differ: a slot
    assert items[1] == "ul" and items[3] == 1  # only one page has it: optional
    assert text[1] == "p" and text[4] == 1 and text[3] == 0  # a repeated group that every page has
    assert html.merge(of("<p>s</p>"), of("<p>s</p>"))[2][0][2][0][2] is not None  # the same on all pages: template
    long = of("".join(f"<{t}>z</{t}>" for t in ("h2", "p", "table", "h3", "dl") for _ in range(1)) * 500)
    assert len(str(long)) < 2000


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    lines_of = np.array([1, 4, 3, 6])
    unary, moves = rng.normal(size=lines_of.sum()), rng.normal(size=(2, 2))
    found, expected = quality.marginals(unary, lines_of, moves, quality.groups_of(lines_of), pairs=True)
    at, wanted, pairs = 0, [], np.zeros((2, 2))
    for n in lines_of:
        total, bad, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = math.exp(sum(u for u, y in zip(unary[at:at + n], labels) if y) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            bad += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                both[a, b] += weight
        wanted.extend(bad / total)
        pairs += both / total
        at += n
    assert np.allclose(found, wanted) and np.allclose(expected, pairs)


def test_quality_held_out(spark):
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = [r for r in queries.op7_quality(spark, SF).collect() if r["held_out"] and r["doc_id"] in label]
    assert sum(r["predicted"] == label[r["doc_id"]] for r in rows) >= 0.93 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_audio_round_trip_and_damage():
    rng = random.Random(2)
    for size in (0, 1, 63, 64, 100, 1397, 1398, 1399, 5000, 100_000):
        payload = audio.padded(bytes(rng.choice((0xFF, 0xFA, 0xE8, 0, 7)) for _ in range(size)))
        stream = audio.write(payload)
        found = audio.read(stream)
        assert found["payload"] == payload and found["bad_crc"] == found["skipped"] == 0 and found["variable"]
        assert found["frames"] == found["declared_frames"] == len(found["offsets"]) and found["samples"] == 1152 * found["frames"]
        assert all(stream[o:o + 2] == b"\xff\xfa" for o in found["offsets"])
    offsets = audio.read(stream)["offsets"]
    broken = stream[:offsets[2]] + b"junk\xff\xfa" + stream[offsets[3]:]  # a frame lost, junk in its place
    found = audio.read(broken)
    assert found["frames"] == len(offsets) - 1 and found["skipped"] == 6
    flipped = bytearray(stream)
    flipped[offsets[1] + 8] ^= 1  # side information that the checksum covers
    assert audio.read(bytes(flipped))["bad_crc"] == 1
    # CRC-16 with polynomial 0x8005 and start 0xFFFF of the digits 1 to 9, a published check value.
    assert audio.crc16(b"123456789") == 0xAEE7


def test_audio_columns(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None), (3, "x" * 3000)], "doc_id bigint, text string")
    facts = {r["doc_id"]: r for r in audio.audio_facts(audio.to_audio(docs)).collect()}
    digest = {r["doc_id"]: r for r in audio.media_digest(docs).collect()}
    assert bytes(facts[3]["payload"]) == audio.padded(b"x" * 3000) and len(facts[3]["offsets"]) == facts[3]["frames"] == 3
    assert digest[2]["payload_bytes"] == 64 and digest[2]["tail_crc32"] == zlib.crc32(bytes(64)) and digest[1]["n_bytes"] == 3
    assert digest[3]["payload_sha256"] == hashlib.sha256(audio.padded(b"x" * 3000)).hexdigest()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 7), (7, 6), (9, 9)] + [(1000, i) for i in range(1001, 1200)]
    found = {r["id"]: r["label"] for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found[160] == 100 and found[6] == 5 and found[1199] == 1000 and 9 not in found
