import random
import time

from pyspark.sql import functions as F

from tidemark.llm import line_join


def brute(docs, t=0.8):
    seen, out = [], []
    for i, text in docs:
        lines = []
        for line in text.split("\n"):
            words = set(line.split())
            if not words:
                lines.append(line)
                continue
            if not any(len(words & s) >= t * len(words | s) - 1e-9 for s in seen):
                lines.append(line)
            seen.append(words)
        out.append((i, "\n".join(lines)))
    return out


def corpus():
    rng = random.Random(2)
    vocabulary = ["fw%d" % int(rng.paretovariate(0.7)) for _ in range(3000)]
    lines = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 25))] for _ in range(150)]
    docs = []
    for i in range(60):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(lines))
            if rng.random() < 0.5 and line:
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            rng.shuffle(line)
            own.append(rng.choice([" ", "  ", "\t", " \r", "\x0b\x0c"]).join(line) + rng.choice(["", " "]))
        docs.append((i, "\n".join(own)))
    return docs


def clean(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_equals_brute_force(make):
    docs = corpus()
    assert clean(line_join.dedup_lines(make(docs))) == brute(docs)


def test_first_round_and_shuffled_texts_change_nothing(make):
    docs = corpus()
    assert clean(line_join.dedup_lines(make(docs), hot=3, most_broadcast=0)) == brute(docs)


def test_every_threshold_and_length_band(make):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, "\n".join(" ".join(rng.sample(words[: rng.choice([8, 60])], rng.randint(1, 8))) for _ in range(5))) for i in range(60)]
    docs += [(100 + i, " ".join(words[: 40 + i])) for i in range(0, 20, 3)]
    for t in (0.4, 0.6, 0.8, 1.0):
        assert clean(line_join.dedup_lines(make(docs), threshold=t, hot=2)) == brute(docs, t)


def test_clashing_columns(make):
    names = ["__kept", "__left", "__split", "__lines", "__removed", "kept", "row", "cut", "s", "i", "l", "line", "k"]
    docs = make([(1, "a b c\nd"), (2, "c b a\n")]).select("*", *[F.lit(n).alias(n) for n in names])
    got = line_join.dedup_lines(docs)
    assert sorted(got.columns) == sorted(docs.columns)
    found = sorted((r["doc_id"], r["text"], r["__lines"], r["__removed"], r["id"], r["kept"], r["s"]) for r in got.collect())
    assert found == [(1, "a b c\nd", 2, 0, 7, "kept", "s"), (2, "", 2, 1, 7, "kept", "s")]


def test_long_documents_are_linear(make):
    def lines(n, own):
        return "\n".join(f"{own}{i} word{i % 7} more{i % 11} and{i % 13} the{i % 3}" for i in range(n))

    docs = [(1, lines(12_000, "a")), (2, lines(12_000, "a") + "\nnew line"), (3, lines(12_000, "b"))]
    got = {r["doc_id"]: r["text"] for r in line_join.dedup_lines(make(docs)).collect()}
    assert got == {1: docs[0][1], 2: "new line", 3: docs[2][1]}


def test_edges(make):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a b\n\n  \nA b\na  b"), (2, None), (3, ""), (4, long), (5, long + " more\nb a"), (6, "x y"), (6, "x y"), (None, "a b")]
    docs = make(rows)
    got = line_join.dedup_lines(docs)
    assert got.columns == [*docs.columns, "__lines", "__removed"]
    found = sorted(((r["doc_id"], r["text"], r["__lines"], r["__removed"]) for r in got.collect()), key=str)
    assert found == sorted([
        (1, "a b\n\n  \nA b", 5, 1), (2, None, 0, 0), (3, "", 1, 0), (4, long, 1, 0), (5, "", 2, 2), (6, "x y", 1, 0), (6, "x y", 1, 0),
        (None, "a b", 0, 0)], key=str)
    assert line_join.dedup_lines(make([])).count() == 0


def test_plan_has_no_python(make, capsys):
    line_join.dedup_lines(make(corpus())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_shuffles_of_written_steps_are_dropped(spark, make):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in map(str, spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found)) if "/shuffle_" in f}

    before = files()
    kept = line_join.kept_lines(make(corpus()))
    for _ in range(50):  # files go in the background
        if files() - before:
            time.sleep(0.1)
    assert not files() - before
    assert kept.count() > 0 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_tests_of_a_pair_are_in_doubles(spark, capsys):
    rows = spark.range(3).select(F.col("id").alias("k"), "id", *[F.col("id").cast("int").alias(c) for c in ("pos", "i", "n")], F.col("id").alias("odd"))
    line_join._met(rows, rows, 0.8, "x.id < y.id").explain()
    assert "decimal" not in capsys.readouterr().out


def test_similarity_just_at_the_threshold_counts(make):
    words = [f"w{i}" for i in range(50)]
    docs = [(1, " ".join(words[:40])), (2, " ".join(words[:50])), (3, " ".join(words[:31] + words[45:])), (4, "a b c d"), (5, "a b c d e"), (6, "a b c e f")]
    assert clean(line_join.dedup_lines(make(docs))) == brute(docs)
    assert clean(line_join.dedup_lines(make(docs), hot=1)) == brute(docs)
