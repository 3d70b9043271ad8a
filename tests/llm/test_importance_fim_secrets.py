"""Importance resampling, fill-in-the-middle and secret scans against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candlewick.llm import fim, importance, secrets
from candlewick.llm.queries import QUERIES
from candlewick.llm.shared import table, written

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, n long, rank long, weight string, blob string, spans int, form int, output string, salt string, k0 string"
EXTRA = ("src", 3, 4, "w", "b", 5, 6, "o", "s", "k")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def integer(digest, at):
    return int(digest[8 * at : 8 * at + 8], 16)


# ---------------------------------------------------------------- importance
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_sample(docs, target):
    s, t = Counter(), Counter()
    made = [(d, *plain_features(x)) for d, x in docs]
    for _, _, f in made:
        s.update(f)
    for x in target:
        t.update(plain_features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    rows = []
    for d, n, f in made:
        w = sum(gain[b] for b in f)
        h = integer(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest(), 0)
        rows.append((d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = 5 * len(able) // 100
    ranks = Counter((*r[:4], i + 1) for i, r in enumerate(able[:drawn]))
    left = Counter(r[:4] for r in rows)
    left.subtract(Counter(r[:4] for r in able[:drawn]))
    return ranks + Counter({(*k, None): n for k, n in left.items() if n > 0})


def as_counter(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_query_equals_plain_python(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert as_counter(QUERIES["op11_importance"](spark, SF)) == plain_sample(docs, target)


def test_crc_of_runs_is_the_crc_of_their_text():
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcxyz019\xc3\xa9", k=rng.choice([1, 2, 3, 7, 40, 300]))) for _ in range(60)]
    got = [sorted(b.tolist()) for b, _ in importance._features([words], [0], 1 << 31)]
    for n in (1, 2, 3):
        assert got[n - 1] == sorted(zlib.crc32(b" ".join(words[i : i + n])) % (1 << 31) for i in range(len(words) - n + 1))


def test_long_texts_are_read_in_pieces_that_share_words(spark, monkeypatch):
    text = "Alpha beta, gamma delta42 épsilon " * 400
    whole = plain_features(text)
    monkeypatch.setattr(importance, "PIECE_BYTES", 97)
    made = Counter()
    for _, words, seen in importance._runs([b"", None, text.encode(), b"!!"]):
        for bucket, _ in importance._features(words, seen, 10000):
            made.update(bucket.tolist())
    assert made == Counter(whole[1])


@pytest.mark.parametrize("seed", range(3))
def test_cutoff_is_the_exact_key(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(-5, 5), rng.randrange(2), rng.randrange(4), rng.randrange(2)) for _ in range(800)]
    keys = written(spark.createDataFrame(rows, "k0 long, k1 long, k2 long, k3 long").repartition(7), "keys")
    ordered = sorted(rows)
    for k in (1, 2, 399, 400, 799, 800):
        assert importance.cutoff_key(keys, k) == ordered[k - 1]
    assert importance.cutoff_key(keys, 0) is None and importance.cutoff_key(keys, 801) is None


def test_odd_rows_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t.,"), (None, "a b " * 30), (None, None)]
    rows += [(k, " ".join(rng.choices(["aa", "Bb", "ç", "42"], k=rng.randrange(5, 60)))) for k in range(10, 150)]
    rows += [(7, "one two three four " * 10)] * 40  # equal rows, more than the draw takes
    docs, target = frame(spark, rows), frame(spark, [(0, "one two three four"), (1, None), (2, "aa bb")])
    assert as_counter(importance.importance_sample(docs, target)) == plain_sample(rows, ["one two three four", None, "aa bb"])
    assert as_counter(importance.importance_sample(docs, target.limit(0))) == plain_sample(rows, [])
    assert importance.importance_sample(docs.limit(0), target).count() == 0


# ---------------------------------------------------------------- fill in the middle
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [integer(digest, i) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(2)
    pieces = ["a", "Wort", "\U0001f600", "é", " ", "\n", "\t ", "\x0b", " ", "<P", ">", "<M>", "$1", "\\", "{3}", "\x00"]
    texts = [None, "", " ", "\n\n", "x", "<S>", "a <P> b", "word " * 50_000, "z" * 300_000, " " * 300_000, "$1 \\2 ${a}"]
    return texts + ["".join(rng.choices(pieces, [6] * 5 + [4] * 4 + [1] * 7, k=rng.randrange(1, 30))) for _ in range(150)]


def test_fim_equals_plain_python(spark):
    rows = [(k, t) for k, t in enumerate(fim_texts())] + [(None, "some words of a text"), (3, "\n\n"), (3, "\n\n")]
    got = fim.fill_in_middle(frame(spark, rows), into="out")
    assert got.columns == [*frame(spark, []).columns, "out"]
    rows_got = got.select("doc_id", "out.n", "out.form", "out.prefix_chars", "out.middle_chars", "out.output", fim.restore_text(F.col("out.output"), F.col("out.form")).alias("back"), F.col("text")).collect()
    assert Counter(tuple(r)[:6] for r in rows_got) == Counter((d, *plain_fim(d, t)) for d, t in rows)
    assert all(r["back"] == (r["text"] or "") for r in rows_got)
    assert {r["form"] for r in rows_got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame(spark, [])).count() == 0


def test_fim_plan_has_no_shuffle_and_no_python(spark):
    plan = QUERIES["op12_fim"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- secrets
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    found += [(m.start(), 3, m.end(), "pem") for m in re.finditer("-----BEGIN [A-Z ]*PRIVATE KEY-----", text)]
    found += [(m.start(), 4, m.end(), "forge") for m in re.finditer("gh[pousr]_[A-Za-z0-9]{36,}", text)]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def secret_texts():
    rng = random.Random(3)
    pieces = ["password", "PassWD", "secret", "token", "API_KEY", "apikey", "=", ": ", " = \"", "abc", "ABC123xyz", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef" * 2]
    pieces += ["é", "\U0001f600", "\n", " ", "'", "ſecret=longenough1", "toKen=longenough2", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "f" * 23, "f" * 24]
    texts = [None, "", "token: token: abcdefgh", "password==abcde", "x" * 400_000 + " secret = 'hunter2hunter2'", "deadbeef" * 50_000, "é" * 1000 + "AKIA" + "Z" * 16]
    return texts + ["".join(rng.choices(pieces, k=rng.randrange(1, 25))) for _ in range(200)]


def spans_of(df):
    return Counter((r[0], r[1]) for r in df.select("doc_id", secrets.span_list(F.col("spans"))).collect())


def test_spans_equal_plain_python(spark):
    rows = [(k, t) for k, t in enumerate(secret_texts())] + [(None, "secret = abcdef1")] + [(9000 + k % 7, "token=copied-secret") for k in range(40)]
    docs = frame(spark, rows).repartition(5)
    assert spans_of(secrets.scan_history(docs, ["doc_id"])) == Counter((d, plain_spans(t)) for d, t in rows)
    assert secrets.scan_history(docs.limit(0), ["doc_id"]).count() == 0


def scanned(spark, folder):
    return [(r.blob.hex()[:8], tuple(r.rules.split(","))) for r in spark.read.schema(secrets.LEDGER_SCHEMA).parquet(folder).collect()]


def test_ledger_scans_only_what_it_has_not_seen(spark):
    ledger = secrets.new_ledger(spark)
    base = secrets.BASE_RULES
    first = spark.createDataFrame([("a.txt", 1, "token=abcdef1"), ("b.txt", 1, "token=abcdef1"), ("c.txt", 1, "none"), ("d.txt", 1, None)], "path string, version int, text string").repartition(3)
    again = first.unionByName(spark.createDataFrame([("a.txt", 2, "token=abcdef1 gone"), ("e.txt", 1, "none")], first.schema))
    paths = ["path", "version"]
    begun = secrets.scan_unseen(first, ledger, rules=base)
    assert len(scanned(spark, begun)) == 3 == len(set(scanned(spark, begun)))
    assert len(scanned(spark, secrets.scan_unseen(again, ledger, rules=base))) == 1  # the one new text
    assert scanned(spark, secrets.scan_unseen(again, ledger, rules=base)) == []
    more = secrets.SecretRule("none", "none")
    later = scanned(spark, secrets.scan_unseen(again, ledger, rules=[*base, more]))
    assert len(later) == 4 and {rules for _, rules in later} == {(more.version,)}  # the new rule alone, over old blobs
    found = {(r.path, r.version): r.s for r in secrets.scan_history(again, paths, ledger, rules=[*base, more]).select("path", "version", secrets.span_list(F.col("spans")).alias("s")).collect()}
    assert found == {("a.txt", 1): "assign:0:13", ("b.txt", 1): "assign:0:13", ("a.txt", 2): "assign:0:13", ("c.txt", 1): "none:0:4", ("e.txt", 1): "none:0:4", ("d.txt", 1): ""}
    changed = [secrets.SecretRule("assign", "token=[a-z]+"), *base[1:]]  # a rule's old findings don't count for its new version
    redone = secrets.scan_history(again, paths, ledger, rules=changed).where("path = 'a.txt' and version = 1").select(secrets.span_list(F.col("spans"))).first()[0]
    assert redone == "assign:0:12"


def test_rows_of_a_scan_that_was_done_twice_count_once(spark):
    ledger = secrets.new_ledger(spark)
    rows = spark.createDataFrame([("a", "secret=abcdefg")], "path string, text string")
    folder = secrets.scan_unseen(rows, ledger)
    spark.read.parquet(folder).write.parquet(f"{ledger}/scan=copy")
    got = secrets.scan_history(rows, ["path"], ledger).select(secrets.span_list(F.col("spans"))).collect()
    assert [r[0] for r in got] == ["assign:0:14"]
