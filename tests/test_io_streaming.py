"""Sources, sinks, whole-job files and streaming intake."""

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.dedupe import dedupe_arrivals, dedupe_first, dedupe_url_title, first_arrivals
from corpusloom.plans import jobs
from corpusloom.sinks import ledger, writers
from corpusloom.sources import corpus, files, resilient
from corpusloom.streaming import intake

def test_missing_spellings(spark, tmp_path):
    write(str(tmp_path / "m.csv"), 'text,label\nNA,literal\n"null",x\nNAN,NaN\n')
    got = sorted(((r.text, r.label) for r in files.read_labeled(spark, str(tmp_path / "m.csv")).collect()), key=str)
    assert got == [("NAN", None), (None, "literal"), (None, "x")]
    raw = files.read_labeled(spark, str(tmp_path / "m.csv"), missing=())
    assert sorted(r.text for r in raw.collect()) == ["NA", "NAN", "null"]


TEXTS = ['plain', 'with, comma', 'a "quoted" word', "two\nlines", "  padded  ", "tab\there", "", None, "back\\slash", "ünï"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(t, "literal") for t in TEXTS], "text string, label string")
    df.repartition(3).write.options(**writers.CSV).csv(str(tmp_path / "c"))
    got = [r.text for r in files.read_labeled(spark, str(tmp_path / "c")).collect()]
    assert sorted(got, key=str) == sorted((t or None for t in TEXTS), key=str)  # an empty field is missing
    df.write.parquet(str(tmp_path / "p.parquet"))
    assert files.read_labeled(spark, str(tmp_path / "p.parquet")).count() == len(TEXTS)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_corpus_scan_and_job(spark, tmp_path):
    head = "index\tlabel\tsentence\tpos\tw_index\ttarget\tword_sense\tdefinition\n"
    line = lambda s, y: f"1\t{y}\t{s}\tN\t0\tw\t\t\n"
    root = str(tmp_path / "corpus")
    write(f"{root}/VUA18/train.tsv", head + "".join(line(f"s{i}", i % 2) for i in range(40)))
    write(f"{root}/VUA18/test.tsv", head + line("t0", 1) + line("t0", 0))
    write(f"{root}/VUA18_pos/verb/train.tsv", head + line("s0", 1) + line("p0", 1))
    words = corpus.scan_corpus(spark, root)
    assert sorted({(r.source, r.pos_folder, r.split) for r in words.collect()}, key=str) == [
        ("VUA18", None, "test"), ("VUA18", None, "train"), ("VUA18_pos", "verb", "train")
    ]
    got = jobs.prepare_word_corpus(spark, root, out=str(tmp_path / "prepared"))
    basic = spark.read.parquet(str(tmp_path / "prepared" / "basic"))
    assert sorted(basic.columns) == ["label", "split", "text"] and basic.count() == 42
    sizes = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": 36, "val": 5, "test": 1}
    row = got.where("text = 's0'").first()
    assert (row.source, row.label) == ("VUA18", "literal") and got.where("text = 'p0'").first().pos == "verb"
    with pytest.raises(ValueError):
        corpus.scan_corpus(spark, str(tmp_path / "nothing"))


def test_available_skips_missing(spark, tmp_path):
    write(str(tmp_path / "a.csv"), "text\nx\n")
    found = files.available(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv"), "g": str(tmp_path / "*.csv")})
    assert list(found) == ["a", "g"]


def test_tolerant_csv(spark, tmp_path):
    write(str(tmp_path / "in" / "a.csv"), "text,score\nok,1\nbad,x\nfine,2\n")
    read = files.read_tolerant(spark, str(tmp_path / "in"), "text string, score bigint")
    assert sorted(r.score for r in read.rows.select("score").collect()) == [1, 2]
    assert sorted(r.text for r in read.rows.select("text").collect()) == ["fine", "ok"]  # pruning changes nothing
    assert [r.record for r in read.rejected.collect()] == ["bad,x"]
    row = read.report().first()
    assert (row.accepted, row.rejected) == (2, 1)


def test_columns_are_found_by_name(spark, tmp_path):
    write(str(tmp_path / "a" / "a.csv"), 'extra,label,text\n1,literal,"two\nlines"\n')
    (row,) = files.read_labeled(spark, str(tmp_path / "a"), "text string, label string").collect()
    assert (row.text, row.label) == ("two\nlines", "literal")
    write(str(tmp_path / "b.csv"), "label\nliteral\n")
    with pytest.raises(ValueError):
        files.read_labeled(spark, str(tmp_path / "b.csv"), "text string, label string")
    write(str(tmp_path / "a" / "b.csv"), "text,label,extra\nx,literal,1\n")  # another order: refused, not swapped
    with pytest.raises(Exception):
        files.read_labeled(spark, str(tmp_path / "a"), "text string, label string").collect()


def test_word_tsv_is_splittable(spark, tmp_path):
    head = "index\tlabel\tsentence\tpos\tw_index\ttarget\tword_sense\tdefinition\n"
    write(str(tmp_path / "w.tsv"), head + "".join(f"i{i}\t0\ta b c\tNN\t1\tb\ts\td\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = files.read_word_tsv(spark, str(tmp_path / "w.tsv"))
        assert df.rdd.getNumPartitions() > 1 and df.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damaged_files_are_reported(spark, tmp_path):
    import bz2
    import gzip

    folder = tmp_path / "in"
    write(str(folder / "a.csv"), "text,score\nok,1\n")
    write(str(folder / "c.csv"), "")
    write(str(folder / "d.csv"), "text\nno score\n")
    write(str(folder / "e.csv"), 'text,score\n"open quote,3\nmore\n')
    (folder / "f.csv").write_bytes(b"score,x,text\n1,,caf\xe9\n2,,fine\n3,,\n")
    lines = ["text,score\n"] + [f"t{i},{i}\n" for i in range(5000)]
    whole = gzip.compress("".join(lines).encode())
    (folder / "b.csv.gz").write_bytes(whole[: len(whole) // 3])
    (folder / "g.csv.gz").write_bytes(gzip.compress(b"text,score\nx,1\n") + gzip.compress(b"y,2\n"))
    (folder / "h.csv.bz2").write_bytes(bz2.compress("".join(lines).encode()))
    write(str(folder / "i.csv.gz"), "not compressed")
    write(str(folder / "_hidden.csv"), "text,score\nno,1\n")
    for task_bytes in (1, 1 << 20):
        read = files.read_tolerant(spark, str(folder), "text string, score bigint")
        got = {os.path.basename(r.input_file): (r.status, r.accepted, r.rejected) for r in read.report().collect()}
        half = got.pop("b.csv.gz")
        assert half[0] == "damaged" and 0 < half[1] < 5000 and half[2] <= 1
        assert got == {
            "a.csv": ("read", 1, 0), "c.csv": ("no record", 0, 0), "d.csv": ("no column", 0, 0), "e.csv": ("read", 0, 1),
            "f.csv": ("read", 2, 1), "g.csv.gz": ("read", 2, 0), "h.csv.bz2": ("read", 5000, 0), "i.csv.gz": ("damaged", 0, 0),
        }
        own = sorted(r.score for r in read.rows.where("input_file LIKE '%b.csv.gz'").collect())
        assert own == list(range(half[1]))
    assert [r.text for r in read.rows.where("input_file LIKE '%f.csv'").orderBy("score").collect()] == ["fine", None]


def test_files_are_listed_by_folder_glob_and_name(spark, tmp_path):
    for name in ("a/x.csv", "a/b/y.csv", "a/_z.csv", "c/x.json"):
        write(str(tmp_path / name), "text\nt\n" if name.endswith("csv") else '{"text": "t"}\n[1]\n')
    names = lambda path: [f[len(f"file:{tmp_path}/") :] for f, _ in resilient.list_files(path)]
    assert names(f"file:{tmp_path}") == ["a/b/y.csv", "a/x.csv", "c/x.json"]
    assert names(f"{tmp_path}/a/*.csv") == ["a/x.csv"] and names(f"{tmp_path}/*") == names(str(tmp_path))
    assert names(f"{tmp_path}/a/_z.csv") == ["a/_z.csv"] and names(f"{tmp_path}/none") == []
    rows = resilient.read_files(spark, str(tmp_path), ["text"], task_bytes=1)
    assert rows.rdd.getNumPartitions() >= 3 and rows.where("text = 't'").count() == 3
    assert [r.record for r in rows.where("record IS NOT NULL").collect()] == ["[1]"]


def test_a_parquet_file_that_breaks(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(20_000).selectExpr("id", "uuid() AS text").coalesce(1).write.option("parquet.block.size", 65536).parquet(path)
    (name,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    data = bytearray((tmp_path / "p" / name).read_bytes())
    middle = len(data) // 2
    data[middle : middle + 2000] = b"\xff" * 2000
    (tmp_path / "broken.parquet").write_bytes(data)
    (report,) = files.read_tolerant(spark, str(tmp_path / "broken.parquet"), "text string", "parquet").report().collect()
    assert report.status == "damaged" and 0 <= report.accepted < 20_000 and report.error


def test_profile_names_every_file(spark, tmp_path):
    write(str(tmp_path / "a.csv"), "text,x\none two,1\n")
    write(str(tmp_path / "b.csv"), "title\nno\n")
    got = files.profile_files(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}).collect()
    assert sorted((r.input_name, r.status, r.tokens_max) for r in got) == [("a", "read", 2), ("b", "no column", None)]
    write(str(tmp_path / "c.parquet"), "not parquet")
    got = files.profile_files(spark, str(tmp_path / "*.*")).collect()
    assert sorted((r.input_name, r.status, r.accepted) for r in got) == [
        ("a.csv", "read", 1), ("b.csv", "no column", 0), ("c.parquet", "damaged", 0),
    ]


def test_append_annotations_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "ann")
    df = spark.range(10).select(F.col("id").alias("row_id"), F.lit("t").alias("text"))
    assert writers.read_annotations(spark, path) is None
    assert writers.append_annotations(df.where("row_id < 6"), path) == 6
    assert [writers.append_annotations(df, path) for _ in range(2)] == [4, 0]
    rows = writers.read_annotations(spark, path)
    assert rows.columns == ["row_id", "text"] and sorted(r.row_id for r in rows.collect()) == list(range(10))


def test_a_crash_between_rows_and_ledger_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ann")
    df = spark.range(8).select(F.col("id").alias("row_id"), F.lit("t").alias("text"))
    writers.append_annotations(df.where("row_id < 3"), path, batch="a")
    with monkeypatch.context() as broken:
        broken.setattr(ledger.Ledger, "commit", lambda *_: 1 / 0)  # rows are written, nothing else
        with pytest.raises(ZeroDivisionError):
            writers.append_annotations(df, path, batch="b")
    assert writers.read_annotations(spark, path).count() == 3
    index = ledger.Ledger(spark, path, "row_id")
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", lambda *_: 1 / 0)  # index rows as well, but no line of the ledger
        with pytest.raises(ZeroDivisionError):
            index.commit("b", df.select("row_id"), "lost", 8)
    assert writers.append_annotations(df, path, batch="b") == 5 and writers.append_annotations(df, path, batch="b") == 0
    index.compact()
    assert sorted(r.row_id for r in writers.read_annotations(spark, path).collect()) == list(range(8))
    assert writers.append_annotations(df, path) == 0
    assert len([n for n in os.listdir(path) if n.startswith("attempt=")]) == 3  # two batches and the empty one


def test_an_append_reads_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "ann")
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.lit("t").alias("text"))
    writers.append_annotations(df, path)
    index = ledger.Ledger(spark, path, "row_id")
    few = df.where("row_id IN (5, 6)")
    touched = sorted(r[0] for r in few.select(index.bucket()).distinct().collect())
    plan = index.known(few)._jdf.queryExecution().executedPlan().toString()
    shown = plan[plan.index("PartitionFilters") :]
    assert "bucket#" in shown and all(str(b) in shown.split("]")[0] for b in touched)
    assert {r.row_id for r in index.known(few).collect()} >= {5, 6} and index.known(few).count() < 200
    assert [r.row_id for r in index.holds([6, 5000]).collect()] == [6]
    assert "In(row_id" in index.holds([6, 5000])._jdf.queryExecution().executedPlan().toString()


def test_arrivals_batch_by_batch_equal_all_at_once(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "c", "d", None, "", "e" * 50]) if i % 3 else f"own {i}") for i in range(120)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    want = {(r.doc_id, r.text) for r in dedupe_first(df, "text", "doc_id").collect()}
    index, left = str(tmp_path / "index"), {}
    for part in (3, 1, 1, 0, 2):
        for r in dedupe_arrivals(df.where(F.col("doc_id") % 4 == part), index, f"p{part}").collect():
            left.pop(r.replaces, None)
            left[r.doc_id] = r.text
    assert set(left.items()) == want
    assert {r["first"] for r in first_arrivals(spark, index).collect()} == {i for i, _ in want}


def test_append_reviews_and_lookup(spark, tmp_path):
    path = str(tmp_path / "rev")
    df = spark.createDataFrame([("m1", "a"), ("m2", "b")], "movie_id string, review_title string")
    writers.append_reviews(df, path)
    writers.append_reviews(df.where("movie_id = 'm1'"), path)
    assert writers.read_reviews(spark, path).count() == 3
    assert sorted(r.movie_id for r in writers.read_reviews(spark, path, "m1").collect()) == ["m1", "m1"]


def test_splits_variants_report_evaluation(spark, tmp_path):
    rows = [(i, f"t {i}", "literal" if i % 3 else "figurative", "train" if i % 2 else "val") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, binary_label string, split string")
    writers.write_splits(df, str(tmp_path / "s"), fmt="parquet")
    back = spark.read.parquet(str(tmp_path / "s")).where("split = 'val'")
    assert back.columns == ["text", "label", "split"] and back.count() == 6
    writers.write_basic_detailed(df, str(tmp_path / "w"), ["text", "split"], partition=["split"])
    assert spark.read.parquet(str(tmp_path / "w" / "basic" / "split=val")).count() == 6
    writers.write_basic_detailed(df, str(tmp_path / "v"), ["doc_id", "text"], fmt="csv")
    basic = spark.read.options(**writers.CSV).csv(str(tmp_path / "v" / "basic"))
    assert basic.columns == ["doc_id", "text"] and basic.count() == 12
    stats = df.agg(F.count("*").alias("total_rows"), F.avg("doc_id").alias("mean_id"))
    counts = df.groupBy("split").agg(F.count("*").alias("n"))
    writers.write_report([("TITLE", stats, None), ("SPLITS", counts, "split")], str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == [
        "TITLE", "total rows: 12", "mean id: 5.5", "SPLITS", "train n: 6", "val n: 6"
    ]
    scored = df.select("doc_id", F.col("binary_label").alias("true_label"), F.array(F.lit(1.0), (F.col("doc_id") % 2) * 2.0).alias("logits"))
    writers.write_evaluation(jobs.evaluate(scored), str(tmp_path / "e"))
    names = {n for n in os.listdir(tmp_path / "e")}
    assert names == {"classification_report", "per_class_metrics", "overall_metrics", "confusion_matrix", "detailed_predictions", "evaluation_summary"}


def articles(spark):
    rows = [
        (1, "s", "http://a/1", "One", "2024-06-01"),
        (2, "s", "http://a/1?x", "Two", "2024-06-02"),
        (3, "s", "http://a/2", "one ", "2024-06-03"),
        (4, "s", None, None, "2024-06-04"),
        (5, "s", None, None, "2024-06-05"),
        (6, "s", "http://a/9", "Undated", None),
        (7, "t", "http://a/1", "One", "2024-06-06"),
    ]
    df = spark.createDataFrame(rows, "page_id long, source string, url string, title string, d string")
    return df.select("page_id", "source", "url", "title", F.col("d").cast("timestamp").alias("publish_ts"))


def run_articles(spark, df, tmp_path, tag):
    out, cp = str(tmp_path / f"out{tag}"), str(tmp_path / f"cp{tag}")
    q = intake.stream_articles(df).writeStream.format("parquet").option("checkpointLocation", cp)
    q.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


def test_stream_equals_batch_for_rows_in_order(spark, tmp_path):
    df = articles(spark)
    for i, r in enumerate(df.collect()):  # one file per row: arrival order is the key order
        spark.createDataFrame([r], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        names = sorted(n for n in os.listdir(tmp_path / "in") if n.endswith(".parquet"))
        newest = max(names, key=lambda n: os.path.getmtime(tmp_path / "in" / n))
        os.utime(tmp_path / "in" / newest, (1_700_000_000 + i * 10,) * 2)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = sorted(r.page_id for r in run_articles(spark, stream, tmp_path, 1).collect())
    want = sorted(r.page_id for r in dedupe_url_title(df.where("publish_ts IS NOT NULL"), "page_id").collect())
    assert got == want == [1, 4, 5, 7]


def test_stream_annotations_restart_adds_nothing(spark, tmp_path):
    landed, sink, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = spark.range(20).select(F.col("id").alias("row_id"), F.concat(F.lit("t"), "id").alias("text"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(landed)
    rows.where("row_id < 12").write.parquet(landed)
    intake.stream_annotations(stream(), sink, cp).awaitTermination()
    intake.stream_annotations(stream(), sink, cp).awaitTermination()
    rows.where("row_id > 6").union(rows.where("row_id > 15")).write.mode("append").parquet(landed)
    intake.stream_annotations(stream(), sink, cp).awaitTermination()
    intake.stream_annotations(stream(), sink, cp + "-lost").awaitTermination()  # all input replayed
    assert sorted(r.row_id for r in writers.read_annotations(spark, sink).collect()) == list(range(20))


def test_news_job_shadows_copies_of_filtered_rows(spark):
    page = lambda lang, title, n: f'<html lang="{lang}"><head><title>{title}</title></head><body><article>{"word " * n}</article></body></html>'
    rows = [
        (1, "s", "http://a/1", page("fr", "Same", 200), "2024-06-20"),  # dropped by language, still shadows 2
        (2, "s", "http://a/2", page("en", "same", 200), "2024-06-20"),
        (3, "s", "http://a/3", page("en", "Long", 600), "2024-06-20"),
        (4, "s", "http://a/4", page("en", "Short", 10), "2024-06-20"),
        (5, "s", "http://a/5", page("", "No language", 200), "2024-06-20"),
        (6, "s", "http://a/6", page("en", "Old", 200), "2024-01-01"),
        (7, "s", "http://a/7", page("en", "Undated", 200), None),
    ]
    df = spark.createDataFrame(rows, "page_id long, source string, url string, html string, d string")
    pages = df.select("page_id", "source", "url", "html", F.col("d").cast("timestamp").alias("ts"))
    got = {r.page_id: r for r in jobs.collect_news(pages, "2024-06-30 12:00:00", date="ts").collect()}
    assert set(got) == {3, 5}
    assert len(got[3].text.split()) == 451 and got[3].publish_date == "2024-06-20"


def test_jobs_write_their_files(spark, tmp_path):
    rows = [(i, f"text number {i} is long", ["literal", "metaphor", "irony"][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    path = lambda name: str(tmp_path / name)
    jobs.prepare_annotations(df, out=path("k3"))
    jobs.prepare_domain(df, "news", out=path("k2"))
    for name in ("k2", "k3"):
        read = spark.read.options(**writers.CSV).csv(path(name))
        assert sorted(read.columns) == ["label", "split", "text"] and read.count() == 60
    jobs.process_long_texts(df, "simple", limit=3, out=path("k4"))
    assert spark.read.parquet(path("k4") + "/rows").where("was_truncated").count() == 60
    assert "truncation rate: 100.0" in [r.value for r in spark.read.text(path("k4") + "/report").collect()]
    post = spark.createDataFrame(
        [("f", "t" * 60, "body", 1, 0, "/p", 1)],
        "forum string, title string, body string, score int, created_utc long, permalink string, position int",
    )
    jobs.collect_forum(post, post.withColumn("body", F.lit("c" * 50)), out=path("k6"))
    assert spark.read.parquet(path("k6") + "/basic").columns == ["text", "source", "type", "score", "timestamp", "url"]
    assert "reddit_f count: 2" in [r.value for r in spark.read.text(path("k6") + "/report").collect()]
    scored = df.select(
        "doc_id", F.lit("m").alias("model"), F.when(F.col("doc_id") < 30, "Reddit").otherwise("News").alias("domain"),
        "text", "label", F.array(F.lit(0.5), (F.col("doc_id") % 2).cast("double")).alias("logits"),
    )
    jobs.evaluate_cross_domain(scored, out=path("k10"))
    assert spark.read.json(path("k10") + "/results_summary").first().model == "m"
    assert spark.read.parquet(path("k10") + "/predictions").count() == 60


def test_the_first_arrival_stays(spark, tmp_path):
    landed, sink, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i, text in enumerate(["zulu", "alpha", "mike"]):  # one file each; values are in no order
        rows = spark.createDataFrame([(1, text), (1, text + " again"), (10 + i, text)], "row_id long, text string")
        rows.coalesce(1).write.mode("append").parquet(landed)
        names = [n for n in os.listdir(landed) if n.endswith(".parquet")]
        newest = max(names, key=lambda n: os.path.getmtime(f"{landed}/{n}"))
        os.utime(f"{landed}/{newest}", (1_700_000_000 + i * 10,) * 2)
    stream = spark.readStream.schema(rows.schema).parquet(landed)
    intake.stream_annotations(stream, sink, cp).awaitTermination()
    got = {r.row_id: r.text for r in writers.read_annotations(spark, sink).collect()}
    assert got == {1: "zulu", 10: "zulu", 11: "alpha", 12: "mike"}


def test_corpus_tags_are_looked_up_by_file(spark, tmp_path):
    from corpusloom.sources.corpus import scan_corpus

    header = "index\tlabel\tsentence\tpos\tw_index\ttarget\tword_sense\tdefinition\n"
    for folder in ("a+b", "c d%2F_pos/adj", "c d%2F_pos"):
        (tmp_path / "x.tsv" / folder / "train.tsv").mkdir(parents=True)
        for part in ("p1.csv", "p2.csv"):
            (tmp_path / "x.tsv" / folder / "train.tsv" / part).write_text(header + f"{folder}\t1\ts t\tx\t0\ts\t\t\n")
    words = scan_corpus(spark, str(tmp_path / "x.tsv"), ("c d%2F_pos", "a+b", "none"), ("adj",))
    got = sorted(tuple(r) for r in words.select("index", "source", "pos_folder", "split", "source_rank", "pos_rank").collect())
    one = [("a+b", "a+b", None, "train", 1, -1), ("c d%2F_pos", "c d%2F_pos", None, "train", 0, -1), ("c d%2F_pos/adj", "c d%2F_pos", "adj", "train", 0, 0)]
    assert got == sorted(one * 2, key=str)
    assert "regexp" not in words._jdf.queryExecution().toString()
