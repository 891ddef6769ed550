"""Statistics that notice edits, and tolerant reading with accounts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ratewise import schemas
from ratewise.operators import stats as S
from ratewise.sources import ingest, readers, stats_store, writers

USERS = "user_id string, review_count bigint, average_stars double"
BUSINESS = "business_id string, stars double, review_count bigint"
U = [(f"u{k}", k % 7, 1.0 + k % 5) for k in range(50)] + [("n", None, None)]
B = [(f"b{k}", 1.0 + k % 9 / 2, k) for k in range(30)] + [("n", None, None)]
NAMES = ["total_reviews", "avg_user_stars", "max_user_reviews", "avg_business_stars", "max_business_reviews"]


def tables(spark, u=U, b=B):
    return spark.createDataFrame(u, USERS), spark.createDataFrame(b, BUSINESS)


def test_states_merge_in_any_order(spark):
    users, _ = tables(spark)
    whole = stats_store.table_state(users, "users").first()
    assert whole == stats_store.table_state(users.repartition(7).orderBy(F.rand(3)), "users").first()
    parts = stats_store.table_state(users.filter("review_count < 3"), "users").unionByName(
        stats_store.table_state(users.filter("review_count >= 3 OR review_count IS NULL"), "users"))
    assert stats_store.merged(parts, "users").first() == whole


@pytest.mark.parametrize("edit", [("u3", 3, 1.0), ("u3x", 3, 4.0), ("u3", 2, 4.0), ("u3", None, 4.0)])
def test_an_edit_of_equal_length_is_noticed(spark, tmp_dir, edit):
    path = os.path.join(tmp_dir, "stats")
    first = writers.global_stats_cached(spark, *tables(spark), path).first()
    stamp = os.stat(path).st_mtime_ns
    assert writers.global_stats_cached(spark, *tables(spark), path).first() == first and os.stat(path).st_mtime_ns == stamp
    want = S.global_stats(*tables(spark)).first()
    assert [first[c] for c in NAMES] == pytest.approx([want[c] for c in NAMES])
    moved = tables(spark, [edit if u[0] == "u3" else u for u in U])
    now = writers.global_stats_cached(spark, *moved, path).first()
    assert now.n_users == first.n_users and now.users_checksum != first.users_checksum
    assert [now[c] for c in NAMES] == pytest.approx([S.global_stats(*moved).first()[c] for c in NAMES])


def test_swapped_values_change_the_checksum(spark):
    a, b = ([("x", 1, 2.0), ("y", 2, 1.0)], [("x", 2, 2.0), ("y", 1, 1.0)])
    assert len({stats_store.table_state(spark.createDataFrame(r, USERS), "users").first().checksum for r in (a, b)}) == 2
    twice = stats_store.table_state(spark.createDataFrame(a + a, USERS), "users").first()
    assert twice.checksum != 0 and twice.n == 4


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for u, n, s in rows:
            f.write(json.dumps({"user_id": u, "review_count": n, "average_stars": s}) + "\n")


def test_only_new_and_changed_files_are_read(spark, tmp_dir):
    folder, store = os.path.join(tmp_dir, "in put"), os.path.join(tmp_dir, "store")

    def look():
        state, n = stats_store.file_stats(spark, folder, store, "users", lambda names: spark.read.schema(schemas.USERS).json(names))
        return state.first(), n

    def whole():
        return stats_store.table_state(spark.read.schema(schemas.USERS).json(folder), "users").first()

    put(folder, "a.json", U[:20])
    put(folder, "b 1+2.json", U[20:])
    assert look() == (whole(), 2) and look() == (whole(), 0)
    put(folder, "c.json", [("new", 9, 5.0)])
    assert look() == (whole(), 1)
    put(folder, "a.json", [(u, n, 2.0) for u, n, s in U[:20]])  # same length, other values
    os.utime(os.path.join(folder, "a.json"), (2e9, 2e9))
    assert look() == (whole(), 1)
    os.remove(os.path.join(folder, "b 1+2.json"))
    assert look() == (whole(), 0) and look() == (whole(), 0)
    put(folder, "empty.json", [])  # a file without bytes is not listed: it holds nothing
    assert look() == (whole(), 0)


def test_statistics_of_states(spark):
    users, business = tables(spark)
    got = stats_store.statistics(stats_store.table_state(users, "users"), stats_store.table_state(business, "business")).first()
    want = S.global_stats(users, business).first()
    assert [got[c] for c in NAMES] == pytest.approx([want[c] for c in NAMES])
    none = stats_store.statistics(*(stats_store.table_state(df.limit(0), k) for df, k in ((users, "users"), (business, "business")))).first()
    assert [none[c] for c in NAMES] == [0.0] * 5 and none.n_users == 0


LINES = ['{"user_id": "a", "review_count": 1}', "", "   ", "{broken", "[1, 2]", '"text"', "null", '{"user_id": "b", "review_count": "many"}', "\t",
         '{"user_id": "c", "review_count": 3} trailing', '{"user_id": "d", "extra": {"x": 1}}', "{}", "x" * 100_000]


def test_counts_equal_the_lines(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    for k in range(3):
        with open(os.path.join(src, f"{k}.json"), "w") as f:
            f.write("\n".join(LINES) + "\n")
    got = ingest.ingest_json(spark, src, schemas.USERS, out)
    assert got.counts["lines"] == 3 * len(LINES) == sum(got.counts[s] for s in ("kept", "blank", "malformed"))
    assert got.counts["blank"] == 9
    assert got.rows.count() == got.counts["kept"] and got.rejected.count() == got.counts["malformed"]
    assert got.rows.columns == schemas.USERS.names
    tolerant = readers.read_users(spark, src, tolerant=True)
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, tolerant.collect()))
    bad = {r.line for r in got.rejected.collect()}
    assert {"{broken", "[1, 2]", "x" * 100_000} <= bad and not any(r.file is None for r in got.rejected.collect())
    assert {f.rsplit("/", 1)[1] for f in (r.file for r in got.rejected.select("file").distinct().collect())} == {"0.json", "1.json", "2.json"}


def test_empty_input(spark, tmp_dir):
    src = os.path.join(tmp_dir, "empty.json")
    open(src, "w").close()
    got = ingest.ingest_json(spark, src, schemas.USERS, os.path.join(tmp_dir, "out"))
    assert got.counts == {"lines": 0, "kept": 0, "blank": 0, "malformed": 0} and got.rows.count() == got.rejected.count() == 0
