"""Operator 12 against its SQL and a plain comparison of every block with every template."""

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from shiftscore.llm import license_scan, registry

from llm_fixtures import edge, empty  # noqa: F401
from llm_rows import SCHEMA, edge_rows, make_text

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc_id, text, templates=license_scan.TEMPLATES, threshold=0.8):
    w = words(text)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best, blocks = set(base), 0.0, set()
    for label, notice in templates:
        seq = words(notice)
        stride = max(8, 1 << (len(seq) - 1).bit_length())
        for at in range(0, len(w), stride):
            common = len(set(seq) & set(w[at:at + 2 * stride]))
            if common >= math.ceil(threshold * len(set(seq)) - 1e-9):
                labels.add(label)
                blocks.add((stride, at))
                best = max(best, common / len(set(seq)))
    return [doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if places else best, len(blocks)]


def licensed_rows():
    rng = random.Random(3)
    rows = [list(r) for r in edge_rows()]
    for k, (label, notice) in enumerate(license_scan.TEMPLATES):
        seq = notice.split()
        gone = [w for w in seq if rng.random() > 0.1]                 # near copies of the notices
        rows[20 + k][1] = f"{make_text(rng, 40, 'en')} {' '.join(gone)} {make_text(rng, 30, 'en')}"
    rows[40][1] = "MIT License mit  license\nThe MIT-License; apache licenses GENERAL public\tlicense"
    rows[41][1] = "éMIT license mıt license MİT license"              # only A-Z are put in lower case
    rows[42][1] = " ".join(license_scan.TEMPLATES[0][1].split()[::-1])  # the words in another order
    rows[43][1] = "license mit apache"
    rows[44][1] = make_text(rng, 3000, "en") + " Licensed under CC BY-NC 4.0 " + make_text(rng, 3000, "en")
    return [tuple(r) for r in rows]


def rows_of(df):
    return sorted(([*r] for r in df.collect()), key=repr)


def test_query_equals_sql_and_plain_version(spark, tmp_path):
    rows = licensed_rows()
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    got = rows_of(registry.QUERIES["op12_license_scan"](spark, str(tmp_path)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert len({r[6] for r in got}) >= 8                                # most notices are found
    assert got == want == sorted(([*r] for r in con.execute(registry.ORACLES["op12_license_scan"]).fetchall()), key=repr)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_no_match_is_lost_by_the_filters(spark, threshold):
    """Blocks of random words over a small vocabulary, so that most share some of a template."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(40)]
    templates = [(f"t{k}", " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate((1, 3, 5, 8, 12, 20, 30))]
    rows = [(k, " ".join(rng.choices(vocabulary, weights=range(1, 41), k=rng.randint(0, 200)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, "w1"), (3, rows[3][1])]
    table, found = license_scan.license_blocks(spark.createDataFrame(rows, "doc_id long, text string"), templates, threshold)
    got = {r.doc_id: sorted(r.labels) for r in table.join(found, "row").groupBy("row", "doc_id").agg(
        F.collect_set("label").alias("labels")).collect()}
    want = {i: p[6].split(",") for i, t in rows if (p := plain(i, t, templates, threshold))[6]}
    assert got == want and want


def test_hot_words_don_t_add_candidates(spark):
    """Every block holds the words that all notices share; none of them is in a prefix."""
    rows = [(k, "under the of and to in this is a " * 200) for k in range(50)]
    table, found = license_scan.license_blocks(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() == 0 and table.count() == 50


def test_templates_without_words_or_too_many_are_refused():
    with pytest.raises(ValueError, match="no word"):
        license_scan.Templates([("x", "--")])
    with pytest.raises(ValueError, match="fewer templates"):
        license_scan.Templates([("x", " ".join(f"w{k}" for k in range(license_scan.MOST_TEMPLATE_WORDS + 1)))])
