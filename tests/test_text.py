"""Cleaning and span rules on hand-written posts."""

import re

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import predicates as P
from laurel.functions import spans as S
from laurel.functions import text as T
from laurel.operators import evidence as E
from laurel.operators import posts as O

RAW = [
    "Look  http://t.co/x   at this 😀",
    "plain",
    "   ",
    None,
    "café wins",
    "above the range \U0001F917",
    "kana カ stays",
    "www.site.com",
    "pic.twitter.com/abc and text\n",
]


def posts(spark, texts):
    rows = [(i, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "post_id bigint, pos bigint, text string")


def test_clean_posts(spark):
    got = {r.post_id: r.text for r in O.clean_posts(posts(spark, RAW)).collect()}
    assert got == {0: "Look at this", 1: "plain", 6: "kana カ stays", 8: "and text"}
    strict = {r.post_id for r in O.clean_posts(posts(spark, RAW), strict_ascii=True).collect()}
    assert strict == {1, 8}


def test_clean_alternate_and_accounts(spark):
    texts = ["RT @a: no", "Hello, #tag World @Bob!", "RT", "RT @b: Best Actor - X", "rt @c x"]
    got = {r.post_id: r.text for r in O.clean_posts_alternate(posts(spark, texts)).collect()}
    assert got == {1: "hello world @bob", 2: "rt"}
    counts = {r.account: r.n for r in O.account_counts(posts(spark, texts)).collect()}
    assert counts == {"@a:": 1, "@b:": 1}


def test_first_fraction(spark):
    for n, expected in [(9, 0), (10, 1), (11, 1), (57, 5)]:
        frame = posts(spark, ["x"] * n)
        got = sorted(r.pos for r in O.first_fraction(frame, 0.1, width=4).collect())
        assert got == list(range(expected))


def test_two_condition_filter_equals_lookahead(spark):
    pattern = re.compile(r"(?=.*award|AWARD)(?=.*wins|Wins|WINS|winner|WINNER).*")
    texts = [
        "award then wins", "wins the award", "AWARD wins", "wins AWARD", "Wins award", "award Wins",
        "award\nwins", "the winner gets an award", "award for the winner", "AWARD AWARD", "WINS",
    ]
    got = [r.p for r in posts(spark, texts).orderBy("pos").select(
        P.has_award_and_win(F.col("text")).alias("p")).collect()]
    assert got == [bool(pattern.search(t)) for t in texts]


def test_award_rules(spark):
    texts = [
        "Argo wins Best Motion Picture - Drama for the year",
        "best a - best b - c",
        "He got the Cecil B. DeMille award",
        "the great big award. was a fine small award here",
        "best actor -- drama",
        "no match here",
        "She won best of all, honestly; best one",
    ]
    tok = T.token_text(F.col("text"))
    rows = posts(spark, texts).orderBy("pos").select(
        S.award_after_best(tok).alias("a"), S.award_suffix(tok).alias("s"), S.award_before(tok).alias("b")
    ).collect()
    assert [r.a for r in rows] == [
        "Best Motion Picture - Drama", "best a - best b", None, None, "best actor", None, "best of all",
    ]
    assert rows[2].s == "Cecil B . DeMille award" and rows[3].s is None
    assert rows[3].b == "the great big"


def test_hope_triples_and_gazetteer(spark):
    texts = [
        "Game Change wins best miniseries or tv movie",
        "i hope The Hour wins best miniseries",
        "rt @x @y Argo wins best drama at the gala",
        "Adele wins the golden prize",
        "wins best nothing",
    ]
    frame = posts(spark, texts)
    got = {r.post_id: r.triple for r in E.triples(E.hope_triples(frame)).collect()}
    assert got == {
        0: "Game Change | best miniseries or tv movie | winner",
        1: "The Hour | best miniseries | nominee",
        2: "Argo | best drama at the gala | winner",
        3: "Adele | the golden prize | winner",
    }
    lower = frame.withColumn("text", F.lower("text"))
    names = spark.createDataFrame(
        [("Game Change", "WORK_OF_ART"), ("The Hour", "WORK_OF_ART"), ("Argo", "WORK_OF_ART")], "name string, label string"
    )
    first = {r.post_id: r.name for r in E.first_spans(E.gazetteer_spans(lower, names)).collect()}
    assert first == {0: "Game Change", 1: "The Hour", 2: "Argo"}


def test_windows_match_python(spark):
    texts = ["Ann Bee presents " + "x" * 60 + " and presenting Cy Dee", "presents", "a presents b present c"]
    got = [sorted(r.w) for r in posts(spark, texts).orderBy("pos").select(
        S.windows_around(F.col("text"), K.PRESENTER_WORDS_NEAR).alias("w")).collect()]
    for text, windows in zip(texts, got):
        expected = []
        for m in re.finditer(r"\b(presenting|presented|presents|present)\b", text):
            expected += [text[max(0, m.start() - 50):m.start()], text[m.end():m.end() + 50]]
        assert windows == sorted(expected)


def test_human_names_and_infer(spark):
    names = ["Tina Fey", "tina", "RT", "Movie", "Amy", "O'Neil", "@Tina", "Ben Affleck "]
    got = [r.h for r in posts(spark, names).orderBy("pos").select(P.is_human_name(F.col("text")).alias("h")).collect()]
    assert got == [True, False, False, False, True, False, False, False]
    texts = ["the best supporting actor of all", "Top Album", "nothing"]
    got = [r.d for r in posts(spark, texts).orderBy("pos").select(S.descriptor_category(F.col("text")).alias("d")).collect()]
    assert got == ["best supporting actor", "Top Album", None]


def test_last_and_first_values(spark):
    rows = [(0, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, "a", "x"), (4, "a", "y")]
    ev = spark.createDataFrame(rows, "pos bigint, award string, name string").withColumn("post_id", F.col("pos"))
    assert {r.award: r.name for r in E.last_value(ev).collect()} == {"a": "y", "b": "z"}
    assert {r.award: r.name for r in E.majority_value(ev).collect()} == {"a": "x", "b": "z"}
    got = sorted((r.award, r.role, r.name) for r in E.first_wins(ev, distinct=True).collect())
    assert got == [("a", "nominee", "x"), ("a", "nominee", "y"), ("a", "winner", "x"), ("b", "winner", "z")]


def test_one_record_for_an_award_of_any_size(spark):
    rows = [("a", "winner", f"n{i:05d}", 1) for i in range(10_500)] + [("b", "nominee", "x", 2)]
    votes = spark.createDataFrame(rows, "award string, role string, name string, n bigint")
    records = {r.name: r for r in E.award_records(votes).collect()}
    assert [(k, r.votes) for k, r in sorted(records.items())] == [("a", 10_500), ("b", 2)]
    assert [e.name for e in records["a"].winner] == [r[2] for r in rows[:-1]]


def test_long_names_are_found_whole(spark):
    long = "The Great Long Walk Home To Rome"
    frame = posts(spark, [f"they say {long} wins", "The Lord Of The Rings The Return Of The King wins", "rome"])
    names = spark.createDataFrame([(long, "W"), ("Rome", "P"), ("", "W")], "name string, label string")
    found = {(r.post_id, r.name) for r in E.gazetteer_spans(frame, names).collect()}
    assert found == {(0, long), (0, "Rome"), (2, "Rome")}
    subjects = [r.s for r in frame.orderBy("pos").select(S.subject(F.col("text")).alias("s")).collect()]
    assert subjects == [long, "The Lord Of The Rings The Return Of The King", None]


def test_accounts_are_data_not_patterns(spark):
    frame = posts(spark, ["RT @a(: hello", "RT @b: x", "nothing"])
    top = spark.createDataFrame([("@a(:", 2, 0)], "account string, n bigint, first_pos bigint")
    assert [r.post_id for r in O.reputable_posts(frame, top, legacy=True).collect()] == [0]


def test_clean_runs_on_a_stream(spark, tmp_path):
    posts(spark, RAW).write.parquet(str(tmp_path / "in"))
    schema = "post_id bigint, pos bigint, text string"
    stream = O.clean_posts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("cleaned").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("cleaned").count() == 4
