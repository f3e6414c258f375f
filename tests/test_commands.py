import json
import os

import pytest

from ladderlake.__main__ import run


def put(path, value):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f)


@pytest.fixture
def lake(tmp_path):
    root = {n: str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold", "all", "csv")}
    for tier in ("GOLD", "SILVER"):
        for division in ("I", "II"):
            rows = [
                {"summonerId": f"{tier}{division}{i}", "summonerName": "n", "tier": tier,
                 "rank": division, "leaguePoints": i, "wins": 20, "losses": i}
                for i in range(4)
            ]
            put(f"{root['raw']}/{tier.lower()}_{division}/1.json", rows)
    return root


def test_standings_step_by_step(spark, lake):
    def go(*argv):
        return run(spark, ["--format", "parquet", *argv])

    status = {r.folder: r.next_page for r in go("landing-status", "--raw", lake["raw"]).collect()}
    assert len(status) == 27
    assert (status["gold_I"], status["gold_III"], status["master_I"]) == (2, 1, 1)
    go("standings-bronze", "--raw", lake["raw"], "--bronze", lake["bronze"])
    go("standings-silver", "--bronze", lake["bronze"], "--silver", lake["silver"], "--tier", "gold")
    gold = go("standings-gold", "--silver", lake["silver"], "--gold", lake["gold"])
    assert gold.count() == 8
    best = go("top-players", "--gold", lake["gold"]).collect()
    assert sorted(r.summonerId for r in best) == ["GOLDI2", "GOLDI3", "GOLDII2", "GOLDII3"]
    go("standings-silver", "--bronze", lake["bronze"], "--silver", lake["silver"], "--tier", "SILVER", "--division", "I")
    everything = go("standings-all", "--silver", lake["silver"], "--gold", lake["all"])
    assert everything.count() == 12
    go("export-csv", "--source", lake["all"], "--target", lake["csv"])
    assert spark.read.csv(lake["csv"], header=True).count() == 12


def test_matches_and_whole_records(spark, tmp_path):
    raw, bronze, gold = (str(tmp_path / n) for n in ("raw", "b", "g"))
    for name in ("gold_1", "silver_2"):
        put(f"{raw}/{name}.json", {"metadata": {"matchId": name}, "info": {"participants": [{"puuid": "p"}]}})
    got = run(spark, ["matches-bronze", "--raw", raw, "--bronze", bronze, "--tier", "gold"])
    assert [(r.tier, r.matchId) for r in got.collect()] == [("GOLD", "gold_1")]
    step = ["republish", "--source", bronze, "--target", gold, "--partition-by", "tier"]
    assert run(spark, step).count() == 1
    run(spark, ["matches-bronze", "--raw", raw, "--bronze", bronze, "--tier", "silver"])
    assert sorted(r.tier for r in run(spark, step).collect()) == ["GOLD", "SILVER"]
    assert os.path.isdir(f"{gold}/tier=SILVER")
    whole = run(spark, ["whole-records", "--raw", raw, "--bronze", str(tmp_path / "w"), "--variant"])
    assert whole.count() == 2


def test_steps_that_go_on_from_the_last_run(spark, lake, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / n) for n in ("matches", "m", "c"))
    merge = ["matches-merge", "--raw", raw, "--bronze", bronze, "--checkpoint", checkpoint]
    for names in (("gold_1", "silver_2"), ("gold_3",)):
        for name in names:
            put(f"{raw}/{name}.json", {"metadata": {"matchId": name}, "info": {"participants": [{"puuid": "p"}]}})
        found = run(spark, merge)
    assert sorted((r.tier, r.matchId) for r in found.collect()) == [
        ("GOLD", "gold_1"), ("GOLD", "gold_3"), ("SILVER", "silver_2")
    ]
    track = ["track-pages", "--raw", lake["raw"], "--status", str(tmp_path / "s"), "--checkpoint", str(tmp_path / "sc")]
    points = {r.folder: r.next_page for r in run(spark, track).collect()}
    assert len(points) == 27 and (points["gold_I"], points["master_I"]) == (2, 1)
    put(f"{lake['raw']}/gold_I/2.json", [{"summonerId": "x", "tier": "GOLD", "rank": "I", "streak": 3}])
    assert {r.folder: r.next_page for r in run(spark, track).collect()}["gold_I"] == 3
    run(spark, ["standings-bronze", "--raw", lake["raw"], "--bronze", lake["bronze"]])
    drift = run(spark, ["record-drift", "--bronze", lake["bronze"]]).collect()
    assert [(r.tier, r.field, r.types) for r in drift] == [("GOLD", "streak", "BIGINT:1")]
    step = ["republish", "--source", lake["bronze"], "--target", lake["gold"], "--partition-by", "tier", "--only-changed"]
    assert run(spark, step).count() == run(spark, step).count() == 17


def test_unknown_step_is_refused(spark):
    with pytest.raises(SystemExit):
        run(spark, ["nothing"])
