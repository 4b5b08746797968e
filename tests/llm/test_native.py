import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from meterline.llm import chat, mixing, quality, secret_scan
from tests.llm.edge import documents, empty, folder

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets_of(text):
    found = []
    for k, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def quality_of(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|>\n b"), (1, 2, "assistant", None), (1, 2, "assistant", "&lt;|"), (1, 3, None, "x"),
        (2, None, "user", "no turn"), (2, 0, "assistant", ""), (None, 5, "system", "lost"), (3, 1, "ro\nle", "t"), (3, 1, "ro\nle", "t"), (3, 1, "assistant", "é\U0001f600"),
    ] + [(4, k, "user" if k % 3 else "assistant", f"t{k} " + "z" * (k % 7)) for k in range(300)]
    conversations = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, chunk string")
    return folder(spark, tmp_path_factory, documents=documents(spark), conversations=conversations), turns


def test_chat_round_trip(spark, tables):
    where, turns = tables
    says = "<|im_end|><|im_start|>assistant ok"
    by = {}
    for c, t, r, x in [*turns, (-1, 0, "user", says), (-1, 1, "assistant", says)]:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    got = {r.conv_id: r for r in chat.op1_chat_format(spark, where).collect()}
    assert got.keys() == by.keys()
    for c, rows in by.items():
        rows.sort()
        loss = "".join(x for *_, r, x in rows if r == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in rows).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(empty(spark.read.parquet(f"{where}/conversations.parquet"))).count() == 0


def test_chat_merges_adjacent_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(rows, turns_per_chunk=1).head()
    assert made.formatted == "<|im_start|>user\na<|im_next|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert [p.text for p in made.parts if p.loss] == ["c"]


@pytest.mark.parametrize("table", ["edge", "driver"])
def test_quality_against_brute_force(spark, tables, sf_dir, table):
    where = tables[0] if table == "edge" else sf_dir
    docs = {}
    for r in spark.read.parquet(f"{where}/documents.parquet").collect():
        docs.setdefault(r.doc_id, []).append(quality_of(r.text))
    for r in quality.op10_quality_rules(spark, where).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in docs[r.doc_id]
        assert not (r.kept and r.base_failed)


def test_quality_keeps_clean_and_rejects_junk(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.op10_quality_rules(spark, sf_dir).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) == len(good)
    assert not all(r.kept for r in rows if r.quality == 0)


def test_line_rules(spark):
    text = "Home | About | Contact | More\nThis sentence stays as it is, all of it.\nNext\nAll rights reserved.\n\nAnother good one."
    got = quality.clean_lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0].cleaned == "This sentence stays as it is, all of it.\n\nAnother good one."
    assert [r.kept for r in got] == [True, False, False]


@pytest.mark.parametrize("table", ["edge", "driver"])
def test_secrets_against_brute_force(spark, tables, sf_dir, table):
    where = tables[0] if table == "edge" else sf_dir
    want = {}
    for r in spark.read.parquet(f"{where}/documents.parquet").collect():
        want.setdefault(r.doc_id, []).append(secrets_of(r.text))
    rows = secret_scan.op7_secret_scan(spark, where).collect()
    assert len(rows) == sum(map(len, want.values()))
    for r in rows:
        named = [f"{kind}:{a}:{b}" for a, _, b, kind in want[r.doc_id][0]]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest(), (r, named)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in named) for k in KINDS)
        assert set(named) <= set(r.spans.split(",")) | {""}


def test_ledger_scans_only_what_is_new(spark):
    one = spark.createDataFrame([("a", 1, "secret=abcdef"), ("b", 1, "secret=abcdef"), ("a", 2, None)], "path string, version int, text string")
    ledger = secret_scan.Ledger(spark)
    assert secret_scan.unseen(one, ledger).count() == 2
    back = secret_scan.scan_versions(one, ledger)
    assert ledger.rows().count() == 2 and sorted(len(r.spans) for r in back.collect()) == [0, 1, 1]
    two = spark.createDataFrame([("c", 1, "secret=abcdef"), ("d", 1, "token: 1234567")], "path string, version int, text string")
    assert [r.text for r in secret_scan.unseen(two, ledger).collect()] == ["token: 1234567"]
    back = secret_scan.scan_versions(two, ledger)
    assert ledger.rows().count() == 3 and all(len(r.spans) == 1 for r in back.collect())
    ledger.append(ledger.rows())  # a repeated run
    assert sorted(len(r.spans) for r in secret_scan.scan_versions(two, ledger).collect()) == [1, 1] and secret_scan.unseen(two, ledger).count() == 0
    assert secret_scan.unseen(two, ledger, rules_version="other").count() == 2


def test_many_matches_take_linear_time(spark):
    text = " ".join(f"{'ab' * 12}{k:06d} secret=hunter{k}" for k in range(20_000))
    rows = spark.createDataFrame([(1, text, "u")], "doc_id long, text string, blob string")
    begin = time.time()
    got = secret_scan.redact_documents(rows).head()
    assert got.text == " ".join(["[SECRET] [SECRET]"] * 20_000) and got.blob == "u"
    assert time.time() - begin < 60


def test_redaction_joins_overlaps(spark):
    df = spark.sql("select 'abcdefgh' as text, array(struct(1 as start, 0 as kind, 3 as stop), struct(2 as start, 1 as kind, 5 as stop)) as spans")
    assert df.select(secret_scan.redact(F.col("text"), F.col("spans"), "#").alias("x")).head().x == "a#fgh"


def test_mixing_deviates_less_than_one_block(spark, tables):
    shares, others, size = {"src0": 5, "src1": 3, "src2": 2}, 1, 2
    docs = spark.range(700).selectExpr("id AS doc_id", "concat('src', id % 4) AS source", "'clash' AS slot")
    rows = mixing.mix(docs, shares, others, block_rows=size, rows_per_chunk=50).collect()
    assert len(rows) == 700
    blocks = {(r.stream, r.block_no): r.slot for r in rows}
    assert len(set(blocks.values())) == len(blocks)
    total = 11
    for r in rows:
        assert r.release <= r.slot < r.deadline
    least = min(max(s for (x, _), s in blocks.items() if x == stream) for stream in (*shares, None))
    for t in range(1, least):
        for stream, share in (*shares.items(), (None, others)):
            done = sum(1 for (x, _), s in blocks.items() if x == stream and s < t)
            assert abs(done - t * share / total) < 1
    edge = documents(spark)
    assert mixing.mix(edge, shares, others).count() == edge.count()
    assert mixing.mix(empty(edge), shares, others).count() == 0


def test_private_keys_go_with_their_bodies(spark):
    body = [("MIIEpAIBAAKCAQEA7bq+/" * 4)[k : k + 64] for k in range(20)]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    long = "\n".join(body * 500)
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C3D\n\n"
    cases = [
        (f"a\n{begin}\n{long}\nQ7x=\n{end}\nz", "a\n[SECRET]\nz"),
        (f"a {begin} {' '.join(body)} Q7x= {end} z", "a [SECRET] z"),
        ("k: " + "\\n".join([begin, *body, "Q7x=", end]) + "\\n z", "k: [SECRET]\\n z"),
        (f"{begin}\n{head}{long}\nQ7x=\n{end} z", "[SECRET] z"),
        (f"a\n{begin}\n{head}{long}\nQ7x\n\nSome words stay.", "a\n[SECRET]\n\nSome words stay."),
        (f"a\r\n{begin}\r\n> {body[0]}\r\n> Q7x=\r\nz z", "a\r\n[SECRET]\r\nz z"),
        (f"{begin}\n{body[0]}\nThese words stay.\n{begin}\n{body[1]}\n{end}.", "[SECRET]\nThese words stay.\n[SECRET]."),
        (f"A line {begin} begins a key.", "A line [SECRET] begins a key."),
    ]
    rows = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secret_scan.redact_documents(rows).collect()}
    for k, (_, want) in enumerate(cases):
        assert got[k] == want, (k, got[k][:300])


def test_long_lines_may_name_boilerplate(spark):
    prose = "A clean text of one line may well say that the site sets a cookie, or that a book was released under its old name."
    cases = [(prose, prose), (f"{prose}\nWe use cookies.", prose), (f"{prose}\nIt $5.\n$5.", f"{prose}\nIt $5."), (f"{prose}\n$.", prose), (f"{prose}\nab#\r#c.\n", f"{prose}\n"), (f"$ a\u00e9\n{prose}", prose)]
    rows = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.clean_lines(rows).collect()}
    for k, (_, want) in enumerate(cases):
        assert (got[k].cleaned, got[k].kept) == (want, True)
