"""Operators 1, 3, 5, 6 and 10, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.llm import chat_format, license_scan, pii, quality_mcd, quality_nbsvm

from .conftest import ODD, WORD, words

SF = "/root/testdata/sf0.01"


def base(text):
    w, text = words(text), text or ""
    count = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_statistics(spark, docs):
    rows = ODD + [(20, "a b c d e a b c d e"), (21, "a a a a a a a"), (22, "x\nx\n x\n\nx"), (23, "# *|ä <b>\x1c\x85z"), (24, "a b c d")]
    for r in quality_mcd.quality_rules(docs(rows)).collect():
        text = next(t for i, t in rows if i == r.doc_id)
        n, chars, symbols, lines, repeated = base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated), text
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert r.kept == (not r.base_failed and r.distance <= quality_mcd.LIMIT)
    assert quality_mcd.quality_rules(docs([])).collect() == []


def brute_mcd(x):
    """The same concentration steps in numpy: location and scatter."""
    q = [np.sort(x[:, i])[[max(0, math.ceil(p * len(x)) - 1) for p in (0.25, 0.5, 0.75)]] for i in range(x.shape[1])]
    mean = np.array([v[1] for v in q])
    scatter = np.diag([((v[2] - v[0]) / 1.349) ** 2 + f * f for v, f in zip(q, quality_mcd.FLOORS, strict=True)])
    for _ in range(quality_mcd.STEPS):
        y = x - mean
        d2 = (y @ np.linalg.inv(scatter) * y).sum(axis=1)
        bins = np.minimum(np.floor(np.log1p(d2) * quality_mcd.BINS_PER_UNIT), quality_mcd.MOST_BIN)
        limit = np.sort(bins)[math.ceil(quality_mcd.SHARE * len(x)) - 1]
        z = x[bins <= limit]
        mean = z.mean(axis=0)
        scatter = (z.T @ z / len(z) - np.outer(mean, mean)) * quality_mcd.SHARE / quality_mcd.INNER_SHARE + np.diag(np.square(quality_mcd.FLOORS))
    return mean, scatter


def brute_distances(good):
    """Squared distances of the rows of a frame with lang, source and vectors."""
    out, k = np.zeros(len(good)), quality_mcd.PRIOR_DOCS
    x = good[list(quality_mcd.X)].to_numpy()
    top = brute_mcd(x)
    for lang in good.lang.unique():
        in_lang = (good.lang == lang).to_numpy()
        w = in_lang.sum() / (in_lang.sum() + k)
        mid = [w * a + (1 - w) * b for a, b in zip(brute_mcd(x[in_lang]), top, strict=True)]
        for source in good.source[in_lang].unique():
            mine = in_lang & (good.source == source).to_numpy()
            w = mine.sum() / (mine.sum() + k)
            mean, scatter = (w * a + (1 - w) * b for a, b in zip(brute_mcd(x[mine]), mid, strict=True))
            y = x[mine] - mean
            out[mine] = (y @ np.linalg.inv(scatter) * y).sum(axis=1)
    return out


def test_distances_equal_numpy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.when((F.col("lang") == "en") & (F.col("doc_id") % 20 != 0), F.lit("s")).otherwise(F.col("source")))
    got = quality_mcd.quality_rules(docs).toPandas().set_index("doc_id")
    vectors = quality_mcd._vectors(quality_mcd.base_statistics(docs)).toPandas().set_index("doc_id")
    assert got[~got.base_failed].distance.notna().all() and got[got.base_failed].distance.isna().all() and not got[got.base_failed].kept.any()
    good = vectors[~got.base_failed.reindex(vectors.index)]
    sizes = good.groupby(["lang", "source"]).size()
    assert sizes.max() > 400 and sizes.min() < 20
    want = brute_distances(good)
    assert np.allclose(got.distance.reindex(good.index), want, rtol=1e-4, atol=1e-4)
    assert ((want <= quality_mcd.LIMIT) == got.kept.reindex(good.index)).all()


def regular(x):
    """The widened scatter, regular by the least standard deviations."""
    return np.cov(x.T, bias=True) * quality_mcd.SHARE / quality_mcd.INNER_SHARE + np.diag(np.square(quality_mcd.FLOORS))


def exact_mcd(x, starts=12, seed=1):
    """MCD by its definition: of samples found by concentration from many random
    starts, the one of least determinant (of its regular scatter)."""
    rng, half, best = np.random.default_rng(seed), math.ceil(quality_mcd.SHARE * len(x)), None
    for _ in range(starts):
        take = rng.choice(len(x), 2 * x.shape[1], replace=False)
        for _ in range(15):
            y = x - x[take].mean(axis=0)
            take = np.argsort((y @ np.linalg.inv(regular(x[take])) * y).sum(axis=1))[:half]
        det = np.linalg.det(regular(x[take]))
        if best is None or det < best[0]:
            best = det, x[take].mean(axis=0)
    return best


def test_estimates_come_near_the_least_determinant(spark):
    """One start from the medians against many random ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'")
    vectors = quality_mcd._vectors(quality_mcd.base_statistics(docs)).toPandas()
    vectors = vectors[(vectors.n_words >= 10) & (5 * vectors.n_repeat_words <= vectors.n_words)]
    x = vectors[list(quality_mcd.X)].to_numpy()
    mean, scatter = brute_mcd(x)
    y = x - mean
    near = np.argsort((y @ np.linalg.inv(scatter) * y).sum(axis=1))[:math.ceil(quality_mcd.SHARE * len(x))]
    det, centre = exact_mcd(x)
    assert np.linalg.det(regular(x[near])) <= 1.25 * det
    assert (np.abs(mean - centre) <= 0.25 * np.sqrt(np.diag(scatter))).all()


def test_one_document_more_moves_nothing_much(spark):
    """No size at which a group's judgement changes: 199, 200 and 201 documents."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en' AND length(text) BETWEEN 300 AND 5000").orderBy("doc_id").limit(1200)
    table = table.withColumn("place", F.row_number().over(Window.orderBy("doc_id"))).persist()
    others = table.where("place > 300").withColumn("source", F.lit("other"))
    found = []
    for n in (199, 200, 201):
        few = table.where(F.col("place") <= n).withColumn("source", F.lit("few"))
        rows = quality_mcd.quality_rules(few.unionByName(others).drop("place")).collect()
        found.append({r.doc_id: r.distance for r in rows if r.distance is not None})
    ids = set(found[0]) & set(found[1]) & set(found[2])
    assert len(ids) > 900
    for a, b in zip(found, found[1:]):
        assert max(abs(a[i] - b[i]) / (1 + a[i]) for i in ids) < 0.25


def test_constant_statistic_in_a_group(spark, docs):
    """Scatter is regular where a statistic is the same everywhere."""
    rows = [(i, " ".join(f"abc{k % 9}" for k in range(i, i + 30 + i % 7))) for i in range(60)]
    got = quality_mcd.quality_rules(docs(rows)).collect()
    assert all(r.distance is None or math.isfinite(r.distance) for r in got)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_rules_keep_clean_documents_and_reject_junk(spark):
    got = quality_mcd.quality_rules(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    both = got.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    clean, junk = both[(both.quality == 1) & ~both.base_failed], both[both.quality == 0]
    assert clean.kept.mean() > 0.99 and junk.kept.mean() < 0.05


def test_tiny_corpus_is_judged(spark, docs):
    """No level has a least size."""
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(60))) for i in range(12)] + [(50, " ".join(f"#$%&|<{k}>*#$%&|<>*" for k in range(60)))]
    got = {r.doc_id: r for r in quality_mcd.quality_rules(docs(rows)).collect()}
    assert not any(r.base_failed or r.distance is None for r in got.values())
    assert [i for i, r in got.items() if not r.kept] == [50]
    (one,) = quality_mcd.quality_rules(docs(rows[:1])).collect()
    assert one.kept and one.distance == 0


def brute_spans(text):
    text = text or ""
    out = []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9](?:[\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


PRIVATE = ["a@b.co, c@@d.e f@g h@i.j.", "x@y.z@w.v.u", "@a.b", "1.2.3.4.5.6.7.8.9", "300.1.1.1 1.2.3.04 000000001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111 4",
           "41111111111111111111111", "+1 (017) 555-7713 +12 +1.......9 ++49 30 123456", "é@b.co +é1.2.3.4é", "token = \"abcdef0123456789\" api_key:ZZZZZZZZZ", "see https://a.b/c?d=e, http://", "hi @some_name!",
           "1.2.3.4@x.yz", "+1 234 567 8901@q.rs", "." * 300 + "1" + " " * 300 + "2", "a.b+c%d-e_f@g-h.i-j.k..l"]


def test_base_spans_equal_the_patterns(spark, docs):
    rows = ODD + [(100 + i, t) for i, t in enumerate(PRIVATE)]
    found = pii.personal_data(docs(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        want = brute_spans(next(t for i, t in rows if i == r.doc_id))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.BASE], r
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans.startswith(text)
    assert pii.personal_data(docs([])).collect() == []


def test_base_spans_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.base_sha256 for r in pii.personal_data(docs).collect()}
    assert got == {r.doc_id: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(r.text)).encode()).hexdigest() for r in docs.collect()}


def test_random_texts_equal_the_patterns():
    import random
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices("0123456789.-+ ()@ab é", k=rng.randint(0, 60)))
        assert pii.described(pii.find(text), pii.BASE) == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(text)), text


def test_added_spans_and_redaction(spark, docs):
    text = "mail a.b@c.de or +1 (017) 555-7713, token = \"abcdef0123456789\" at https://x.yz/q. by @some_name"
    found = pii.find(text)
    assert [text[a:b] for a, b in found["url"]] == ["https://x.yz/q"]
    assert [text[a:b] for a, b in found["account"]] == ["@some_name"]
    assert pii.redact(text, found) == "mail <EMAIL> or <PHONE>, token = \"<SECRET>\" at https://x.yz/q. by @some_name"
    table = docs([(1, text), (2, None), (3, "")])
    rows = {r.doc_id: r for r in pii.redacted(table).collect()}
    assert pii.redacted(table).schema == table.schema and rows[2].text is None and rows[3].text == "" and "<EMAIL>" in rows[1].text


@pytest.mark.parametrize(("text", "secret"), [
    ("Api-Key: abcdefgh12", "abcdefgh12"), ("API_Key=abcdefgh12", "abcdefgh12"), ("PassWord = abcdefgh12 x", "abcdefgh12"),
    ("password: Sup3rSecret!x9#k", "Sup3rSecret!x9#k"), ("password: Sup3r$ecret9\nnext", "Sup3r$ecret9"), ("token='a b $ecret;9', more", "a b $ecret;9"), ('token="$ecret;99 never closed', "$ecret;99"),
    ("İ PassWord=abcdefgh12", "abcdefgh12"), ("secret: short", None), ("a secret without a mark", None)])
def test_secrets_of_any_case_are_taken_whole(text, secret):
    assert [text[a:b] for a, b in pii.find(text)["secret"]] == ([secret] if secret else [])
    assert pii.redact(text, pii.find(text)) == (text.replace(secret, "<SECRET>") if secret else text)


def test_classifier(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_nbsvm.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out]
    ranks = held.score.rank()
    up = held.quality == 1
    auc = (ranks[up].sum() - up.sum() * (up.sum() + 1) / 2) / (up.sum() * (~up).sum())
    assert auc > 0.97 and (held.predicted == held.quality).mean() > 0.94


def test_classifier_odd_rows(spark, docs):
    labels = spark.createDataFrame([(6, 1, 9), (4, 0, 9), (4, None, 9), (None, 1, 9), (3, 7, 9)], "doc_id long, quality int, text int")
    for table in (labels, labels.limit(0), labels.where("quality = 1")):
        got = quality_nbsvm.quality_scores(docs(ODD), table).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert quality_nbsvm.quality_scores(docs([]), labels).collect() == []


def test_classifier_takes_one_row_of_a_labelled_id(spark, docs, monkeypatch):
    """One id in a third of the rows, and a bound on all features."""
    texts = [(i, f"text number {i} of some kind " * (1 + i % 5)) for i in range(40)]
    rows = texts + [(5, f"other text {k % 7}") for k in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = quality_nbsvm.sample(docs(rows), labels).collect()
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(r.doc_id for r in got) == ids
    monkeypatch.setattr(quality_nbsvm, "FEATURES", 900)
    few = quality_nbsvm.sample(docs(texts), labels).collect()
    assert 0 < len(few) < len(ids) and sum(len(r.features) for r in few) <= 900


def test_fit_equals_a_dense_one():
    """Hinge loss with the log-count ratios, solved on a dense matrix to its optimum."""
    rng = np.random.default_rng(11)
    kinds = ["good words here and there", "b@d #$%& sp*m"]
    texts = [(y, "".join(rng.choice(list(kinds[1 - y] + "xyz "), rng.integers(5, 60)))) for y in rng.integers(0, 2, 240).tolist()]
    rows = []
    for y, t in texts:
        data = t.encode()
        grams = {int.from_bytes(bytes([n]) + data[i:i + n], "big") for n in quality_nbsvm.ORDERS for i in range(len(data) - n + 1)}
        slots = {((g * 2654435769) & 0xFFFFFFFF) >> (32 - quality_nbsvm.BITS) for g in grams}
        made, = quality_nbsvm._per_text(__import__("pyarrow").array([t]), lambda f: set(f.tolist()))
        assert made == slots
        rows.append((y, np.array(sorted(slots), np.int64)))
    model = quality_nbsvm.Model.__new__(quality_nbsvm.Model)
    model.weights, model.ratio, model.bias = np.zeros(1 << quality_nbsvm.BITS), np.zeros(1 << quality_nbsvm.BITS), 0.0
    model._fit(rows)

    used = sorted({f for _, fs in rows for f in fs.tolist()})
    x = np.array([[f in set(fs.tolist()) for f in used] for _, fs in rows], float)
    y = np.array([1 if q else -1 for q, _ in rows])
    table = 1 << quality_nbsvm.BITS
    shares = [(x[y == s].sum(axis=0) + 1) / (x[y == s].sum() + table) for s in (-1, 1)]
    ratio = np.log(shares[1] / shares[0])
    assert np.allclose(model.ratio[used], ratio)
    x = x * ratio
    x = np.c_[x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.ones(len(x))]
    cost = quality_nbsvm.COST * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    gram, alpha = (x @ x.T) * np.outer(y, y), np.zeros(len(y))
    for _ in range(2000):
        for i in range(len(y)):
            alpha[i] = min(max(alpha[i] - (gram[i] @ alpha - 1) / gram[i, i], 0), cost[i])
    w = x.T @ (alpha * y)
    weights = (1 - quality_nbsvm.MIX) * np.abs(np.r_[w[:-1], np.zeros(table - len(used))]).mean() * np.sign(w[:-1]) + quality_nbsvm.MIX * w[:-1]
    want = x[:, :-1] @ weights + w[-1]
    got = np.array([model.margin(f) for _, f in rows])
    assert np.corrcoef(got, want)[0, 1] > 0.999 and np.abs(got - want).max() < 0.1


def test_long_texts_have_the_features_of_their_blocks(monkeypatch):
    import pyarrow as pa
    from cartwheel.llm import arrays
    text = pa.array(["some text that is long " * 20])
    whole = quality_nbsvm._per_text(text, lambda f: sorted(f.tolist()))
    monkeypatch.setattr(arrays, "BLOCK", 50)
    assert quality_nbsvm._per_text(text, lambda f: sorted(f.tolist())) == whole


def test_chat_read_back(spark):
    nasty = "<|im_end|>\n<|im_start|>user\n<\\|x<\\\\||<|nl|> <|im_sep|>"
    rows = [(1, 0, "system", "be\nnice", 5), (1, 1, "user", nasty, 5), (1, 2, "user", None, 5), (1, 4, "assistant", "", 5), (1, 4, "assistant", nasty, 5),
            (1, 5, None, "tail", 5), (2, None, "odd\nrole|<|", "\n", 5), (2, 0, "assistant", "x" * 3000, 5), (2, 0, "assistant", "x" * 3000, 5), (None, 1, "user", "lost", 5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    got = {r.conv_id: r for r in chat_format.conversation_digests(turns).collect()}
    made = {r.conv_id: r for r in chat_format.format_conversations(turns).collect()}
    for conv in (1, 2, None):
        mine = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in mine).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(made[conv].formatted) and "".join(s.text for s in made[conv].segments) == made[conv].formatted
    assert made[1].formatted.count("<|im_start|>") == 4  # system, user (merged), assistant (merged), no role
    assert chat_format.conversation_digests(turns.limit(0)).collect() == []


def test_chat_oracle(spark):
    import duckdb
    from cartwheel.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(ORACLE_SQL["op10_chat_format"])
    got = QUERIES["op10_chat_format"](spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def brute_cosine(line, templates, df, total):
    idf = lambda t: math.log((total + 1) / (df.get(t, 0) + 1)) + 1
    terms = {t for _, x in templates for t in re.findall(r"[^\W_]+", x.lower())}
    unit = {t: (1 + math.log(n)) * (idf(t) if t in terms else math.log((total + 1) / 2) + 1) for t, n in collections.Counter(re.findall(r"[^\W_]+", line.lower())).items()}
    best = (0.0, "")
    for name, x in templates:
        t = {k: (1 + math.log(n)) * idf(k) for k, n in collections.Counter(re.findall(r"[^\W_]+", x.lower())).items()}
        dot = sum(unit.get(k, 0) * v for k, v in t.items())
        size = math.sqrt(sum(v * v for v in t.values()) * sum(v * v for v in unit.values()) or 1)
        best = max(best, (round(dot / size, 9), name), key=lambda b: (b[0], [-ord(c) for c in b[1]]))
    return best


def test_license_scan(spark):
    mit, apache = license_scan.TEMPLATES[0][1], license_scan.TEMPLATES[1][1]
    files = [("LICENSE", mit), ("a/LICENSE.txt", f"{apache}\n"), ("a/x.py", f"code\n# {mit}\nmore"), ("a/b/c/y.py", "code the under"), ("z/w.py", "code"), ("a/b/LICENSE", "nothing"),
             ("ab/q.py", "x"), (None, None), ("d/e", "Released under the MIT terms and this and that and another long tail of words"), ("a/x.py", "second row of one path"), ("top", "")]
    table = spark.createDataFrame([(p, t, "clash") for p, t in files], "path string, text string, license string")
    got = {r.path: (r.license, r.inherited, r.inherited_from) for r in license_scan.scan(table).collect()}
    assert got == {"LICENSE": ("MIT", None, None), "a/LICENSE.txt": ("Apache-2.0", None, None), "a/x.py": ("MIT", None, None), "a/b/c/y.py": (None, "Apache-2.0", "a"),
                   "z/w.py": (None, "MIT", ""), "a/b/LICENSE": (None, "Apache-2.0", "a"), "ab/q.py": (None, "MIT", ""), "": (None, "MIT", ""), "d/e": (None, "MIT", ""), "top": (None, "MIT", "")}
    assert license_scan.scan(table.limit(0)).collect() == []


def test_license_lines_of_the_table_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.license, r.score) for r in license_scan.document_licenses(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    terms = {t for _, x in license_scan.TEMPLATES for t in re.findall(r"[^\W_]+", x.lower())}
    df = collections.Counter(t for r in rows for t in terms & set(re.findall(r"[^\W_]+", r.text.lower())))
    for r in rows:
        score, name = max((brute_cosine(line, license_scan.TEMPLATES, df, len(rows)) for line in r.text.split("\n") + ([r.text] if len(r.text) <= 400 else [])), key=lambda b: (b[0], [-ord(c) for c in b[1]]))
        if score >= license_scan.LEAST:
            assert got[r.doc_id][0] == name and got[r.doc_id][1] == pytest.approx(score, abs=1e-6), r.doc_id
        else:
            assert got[r.doc_id] == (None, None)


def counted_cosine(line, template, df, total):
    """Cosine with the counted frequency of every term."""
    def vector(text):
        return {t: (1 + math.log(n)) * (math.log((total + 1) / (df[t] + 1)) + 1) for t, n in collections.Counter(re.findall(r"[^\W_]+", text.lower())).items()}
    unit, other = vector(line), vector(template)
    return sum(w * other.get(t, 0) for t, w in unit.items()) / math.sqrt(sum(w * w for w in unit.values()) * sum(w * w for w in other.values()))


@pytest.mark.parametrize("n_files", [60, 6000])
def test_license_scan_counts_every_term(spark, n_files):
    """Words of half of the files weigh little, words of one file much, however many files there are."""
    mit = license_scan.TEMPLATES[0][1]
    often = "en a on la de el un es in at to by"
    common, rare = f"{mit} {often}", f"{mit} qa qb qc qd qe qf qg qh qi qj qk ql"
    rows = [(f"f/{i}", often if i % 2 else f"none{i}") for i in range(n_files)] + [("p/common", common), ("p/rare", rare)]
    df = collections.Counter(t for _, text in rows for t in set(re.findall(r"[^\W_]+", text.lower())))
    got = {r.path: (r.license, r.score) for r in license_scan.scan(spark.createDataFrame(rows, "path string, text string")).where("path LIKE 'p/%'").collect()}
    want = {path: counted_cosine(line, mit, df, len(rows)) for path, line in (("p/common", common), ("p/rare", rare))}
    assert want["p/rare"] < license_scan.LEAST < want["p/common"]
    assert got["p/rare"] == (None, None)
    assert got["p/common"][0] == "MIT" and got["p/common"][1] == pytest.approx(want["p/common"], abs=1e-6)


def test_pipeline(spark):
    """Every stage's decisions, against the operators' definitions."""
    import corpus_pipeline
    from cartwheel.llm import decontaminate, jaccard_join
    from .test_sets import brute_components
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.columns
    (_, rules), (_, copies), (_, clean), (_, private), (_, packing) = corpus_pipeline.STAGES
    after = rules(spark, kept, SF).cache()
    assert after.columns == columns
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality_mcd.quality_rules(docs).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in after.collect()]
    unique = copies(spark, after, SF).cache()
    assert unique.columns == columns
    assert {r.doc_id for r in unique.collect()} == {c for _, c in brute_components(rows).values()}
    left = clean(spark, unique, SF).cache()
    leaked = {r.doc_id for r in decontaminate.leaks(unique, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaked and {r.doc_id for r in left.collect()} == {r.doc_id for r in unique.collect()} - leaked
    redacted = private(spark, left, SF).cache()
    texts = {r.doc_id: r.text for r in redacted.collect()}
    assert redacted.columns == columns and len(texts) == left.count()
    assert not any(brute_spans(t) for t in texts.values()) and all(r.n_chars == len(r.text) for r in redacted.collect())
    pieces = packing(spark, redacted, SF).collect()
    assert {r.doc_id for r in pieces} == set(texts)
    assert len(pieces) == corpus_pipeline.run(spark, SF).count()
    assert jaccard_join.jaccard_components(unique).where("doc_id != component_id").count() == 0


def test_pipeline_odd_rows(spark, docs):
    import corpus_pipeline
    kept = docs(ODD)
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, kept, SF)
        assert out.columns == kept.columns, name
        assert function(spark, kept.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, kept.limit(0), SF).count() == 0


def test_stages_decide_by_row_not_by_id(spark, docs):
    """Rows without an id are judged, and one id's rows apart from each other."""
    import corpus_pipeline
    stages = dict(corpus_pipeline.STAGES)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where(F.length("text") > 200).first().text
    good = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    texts = lambda df: sorted(r.text for r in df.collect())
    junk = "a b c d e " * 30
    rows = [(1, good(1)), (1, junk), (None, junk), (None, good(2)), (2, good(3)), (2, good(4))]
    assert texts(stages["quality_rules"](spark, docs(rows), SF)) == sorted([good(1), good(2), good(3), good(4)])
    rows = [(1, good(1)), (1, good(2)), (None, good(1)), (None, good(3)), (None, good(3)), (5, good(2) + " more"), (6, None), (7, None), (8, "")]
    left = stages["near_duplicates"](spark, docs(rows), SF)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == \
        sorted([(1, good(1)), (1, good(2)), (None, good(3)), (6, None), (7, None), (8, "")], key=str)
    rows = [(1, good(1)), (1, item), (None, item), (None, good(2)), (3, None)]
    left = stages["decontamination"](spark, docs(rows), SF)
    assert sorted((r.text for r in left.collect()), key=str) == sorted([good(1), good(2), None], key=str)
