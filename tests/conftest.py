import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        # Tiny data, many plans: the time goes into compiling, so compile less, and split less.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def league(spark):
    from checks.star_league import star_league

    return star_league(spark, TESTDATA)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


# --- synthetic documents ------------------------------------------------------------------------

CHIP_FLAGS = ["islimitlesstaken", "iswildcardtaken", "isfinalfixtaken", "isautopilottaken",
              "isnonigativetaken", "isextradrstaken"]
CHIP_RACES = ["limitlesstakengd", "wildcardtakengd", "finalfixtakengd", "autopilottakengd",
              "nonigativetakengd", "extradrstakengd"]
ASSETS = list(range(1, 10))
TEAMS = [("ann", 1, "Ann%20One"), ("bob", 1, "Bob+50%zz"), ("cat", 2, "Cat%20%C3%A9")]


def asset_document(race):
    value = [
        {"PlayerId": str(a), "Skill": "1", "PositionName": "DRIVER" if a < 8 else "CONSTRUCTOR",
         "Value": f"{10 + a + race / 10:.1f}", "OldPlayerValue": f"{10 + a}",
         "FUllName": f"Asset {a}", "DisplayName": f"A{a}", "GamedayPoints": f"{a * race}.0",
         "OverallPpints": str(a * race), "SelectedPercentage": "12.5", "TeamId": "",
         "QualifyingPoints": "x", "BestRaceFinished": 3, "old_Value": "9", "new_value": "9",
         "SessionWisePoints": [{"sessiontype": "Race", "points": 3}],
         "AdditionalStats": {"fastest_lap_pts": 10, "value_for_money": "0.5"}}
        for a in ASSETS
    ]
    return {"Data": {"Value": value, "FeedTime": {"UTCTime": f"3/{race}/2026 5:04:09 PM"}}}


def lineup(team, race):
    start = TEAMS.index(team)
    ids = [(start + race + k) % 9 + 1 for k in range(7)]
    return ids


def standings_document(race, teams=TEAMS):
    board = [
        {"user_guid": guid, "team_no": no, "cur_rank": i + 1, "cur_points": 100 - 10 * i + race,
         "team_name": name, "user_name": f"secret {guid}", "trend": 0,
         "user_team": [str(a) for a in lineup((guid, no, name), race)]
         + (["9"] if swapped(guid, race) and 9 not in lineup((guid, no, name), race) else [])}
        for i, (guid, no, name) in enumerate(teams)
    ]
    return {"Value": {"leaderboard": board}, "FeedTime": {"UTCTime": "12/31/2026 11:59:59 AM"}}


def swapped(guid, race):
    """Ann plays the third chip in race 1: eight stored assets, one in and one out."""
    return guid == "ann" and race == 1


def team_document(team, race):
    guid, no, name = team
    ids = lineup(team, race)
    players = [
        {"id": str(a), "iscaptain": int(k == 0), "ismgcaptain": 0, "playerpostion": k + 1,
         "isfinal": 0} for k, a in enumerate(ids)
    ]
    if swapped(guid, race) and 9 not in ids:
        players[6]["isfinal"] = 2
        players.append({"id": "9", "iscaptain": 0, "ismgcaptain": 0, "playerpostion": 8,
                        "isfinal": 1})
    record = {
        "teamno": no, "teamname": name, "socialId": 4711, "teambal": 2.5, "maxteambal": 101.5,
        "usersubs": 1, "usersubsleft": 1, "matchday": 1, "playerid": players,
        "team_info": {"teamBal": 2.5},
        **{f: 0 for f in CHIP_FLAGS}, **{f: None for f in CHIP_RACES},
    }
    if guid != "bob":
        record["teamval"] = 99.0
    if guid == "ann":
        record.update({"isfinalfixtaken": 3, "finalfixtakengd": 1,
                       "isextradrstaken": 6, "extradrstakengd": 9})
    if guid == "bob" and race >= 2:
        record.update({"islimitlesstaken": 1, "limitlesstakengd": 2})
    return {"Data": {"Value": {"mdid": race, "userTeam": [record]}}}


def put(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document, indent=2))


def write_race(folder, race):
    put(folder / "asset_snapshot", f"asset_snapshot_race_{race}.json", asset_document(race))
    put(folder / "league_standings", f"league_standings_race_{race}.json",
        standings_document(race))
    for team in TEAMS:
        put(folder / "detailed_teams", f"{team[0]}_team_{team[1]}_race_{race}.json",
            team_document(team, race))


def write_reference(folder):
    folder.mkdir(parents=True, exist_ok=True)
    calendar = ["season,race_number,race_name,country,city_or_location,circuit_name,"
                "weekend_start_date,weekend_end_date,race_date,sprint_weekend,race_short_name"]
    calendar += [
        f"2026,{n},Race {n},Land,Town,Ring,2026-0{n}-06,2026-0{n}-08,2026-0{n}-08,"
        f"{'True' if n % 2 else 'False'},T{n}" for n in range(1, 10)
    ]
    (folder / "races_2026.csv").write_text("\n".join(calendar) + "\n")
    chips = ["chip_id,chip_key,api_name,display_name,available_first_race,chip_short_name"]
    chips += [f"{k},key{k},api{k},Chip {k},1,C{k}" for k in range(1, 7)]
    (folder / "chips_2026.csv").write_text("\n".join(chips) + "\n")


@pytest.fixture
def raw(tmp_path):
    """Documents of two completed races and the next price feed, with the reference tables."""
    folder = tmp_path / "raw"
    for race in (1, 2):
        write_race(folder, race)
    put(folder / "asset_snapshot", "asset_snapshot_race_3.json", asset_document(3))
    write_reference(folder / "reference")
    return folder
