"""Declared tables: column names and types that landed data is brought to."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = "string", "bigint", "double", "boolean"


def struct(columns: dict[str, str]) -> T.StructType:
    """A StructType of a name-to-type table."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))


# The canonical pitch columns.
PITCH = {
    "pitch_type": S, "game_date": S, "release_speed": D, "release_pos_x": D, "release_pos_z": D,
    "player_name": S, "batter": L, "pitcher": L, "events": S, "description": S, "spin_dir": S,
    "spin_rate_deprecated": S, "break_angle_deprecated": S, "break_length_deprecated": S, "zone": L,
    "des": S, "game_type": S, "stand": S, "p_throws": S, "home_team": S, "away_team": S, "type": S,
    "hit_location": D, "bb_type": S, "balls": L, "strikes": L, "game_year": L, "pfx_x": D, "pfx_z": D,
    "plate_x": D, "plate_z": D, "on_3b": D, "on_2b": D, "on_1b": D, "outs_when_up": L, "inning": L,
    "inning_topbot": S, "hc_x": D, "hc_y": D, "tfs_deprecated": S, "tfs_zulu_deprecated": S,
    "fielder_2": L, "umpire": S, "sv_id": S, "vx0": D, "vy0": D, "vz0": D, "ax": D, "ay": D, "az": D,
    "sz_top": D, "sz_bot": D, "hit_distance_sc": D, "launch_speed": D, "launch_angle": D,
    "effective_speed": D, "release_spin_rate": D, "release_extension": D, "game_pk": L,
    "pitcher_duplicated_0": L, "fielder_2_duplicated_0": L, "fielder_3": L, "fielder_4": L,
    "fielder_5": L, "fielder_6": L, "fielder_7": L, "fielder_8": L, "fielder_9": L, "release_pos_y": D,
    "estimated_ba_using_speedangle": D, "estimated_woba_using_speedangle": D, "woba_value": D,
    "woba_denom": D, "babip_value": D, "iso_value": D, "launch_speed_angle": D, "at_bat_number": L,
    "pitch_number": L, "pitch_name": S, "home_score": L, "away_score": L, "bat_score": L,
    "fld_score": L, "post_away_score": L, "post_home_score": L, "post_bat_score": L,
    "post_fld_score": L, "if_fielding_alignment": S, "of_fielding_alignment": S,
}

# Columns every landed pitch or leaderboard CSV brings to one type.
CSV_OVERRIDES = {
    "pitcher": L, "batter": L, "player_id": L, "year": L, "release_speed": D, "zone": L, "balls": L,
    "strikes": L, "game_year": L, "outs_when_up": L, "inning": L, "launch_speed": D,
    "launch_angle": D, "game_pk": L, "bat_speed": D, "swing_length": D, "miss_distance": D,
}

# Order of pitches, every key descending.
PITCH_ORDER = ("game_date", "game_pk", "at_bat_number", "pitch_number")
FIRST_PITCH_SEASON = 2008
SEASON_COLUMN = "year"

# Park factors and the names they land under.
PARK_FACTOR_NAMES = {
    "venue_id": "venue_id", "venue_name": "venue_name", "main_team_id": "team_id",
    "name_display_club": "team_name", "key_year": "year", "year_range": "year_range",
    "key_bat_side": "bat_side", "n_pa": "n_pa", "index_woba": "park_factor",
    "index_runs": "runs_factor", "index_hr": "hr_factor", "index_hits": "hits_factor",
    "index_1b": "singles_factor", "index_2b": "doubles_factor", "index_3b": "triples_factor",
    "index_so": "so_factor", "index_bb": "bb_factor", "index_hardhit": "hard_hit_factor",
}
PARK_FACTOR_REQUIRED = ("venue_id", "venue_name", "year")
PARK_FACTOR = {
    "venue_id": L, "venue_name": S, "team_id": L, "team_name": S, "year": L, "year_range": S,
    "bat_side": S, "n_pa": L, "park_factor": L, "woba_factor": L, "runs_factor": L, "hr_factor": L,
    "hits_factor": L, "singles_factor": L, "doubles_factor": L, "triples_factor": L, "so_factor": L,
    "bb_factor": L, "hard_hit_factor": L,
}

# Wins-above-replacement tables.
WAR_REQUIRED = ("name_common", "mlb_ID", "player_ID", "year_ID", "team_ID")
WAR_BATTING = {
    "name_common": S, "mlb_ID": S, "player_ID": S, "year_ID": L, "team_ID": S, "stint_ID": L,
    "lg_ID": S, "pitcher": S, "G": L, "PA": L, "salary": D, "runs_above_avg": D,
    "runs_above_avg_off": D, "runs_above_avg_def": D, "WAR_rep": D, "WAA": D, "WAR": D,
}
WAR_PITCHING = {
    "name_common": S, "mlb_ID": S, "player_ID": S, "year_ID": L, "team_ID": S, "stint_ID": L,
    "lg_ID": S, "G": L, "GS": L, "RA": D, "xRA": D, "BIP": L, "BIP_perc": D, "salary": D,
    "ERA_plus": L, "WAR_rep": D, "WAA": D, "WAA_adj": D, "WAR": D,
}

# Player register and team crosswalk.
REGISTER = {
    "name_last": S, "name_first": S, "key_mlbam": L, "key_retro": S, "key_bbref": S,
    "key_fangraphs": L, "mlb_played_first": D, "mlb_played_last": D,
}
REGISTER_MLB_COLUMNS = ("key_retro", "key_bbref", "key_fangraphs", "mlb_played_first", "mlb_played_last")
CROSSWALK_REQUIRED = ("lgID", "teamID", "yearID")
CROSSWALK = {"lgID": S, "teamID": S, "yearID": L}

# Headerless files.
ROSTER_FILE = ("player_id", "last_name", "first_name", "bats", "throws", "team", "position")
SCHEDULE_FILE = (
    "date", "game_num", "day_of_week", "visiting_team", "visiting_team_league",
    "visiting_team_game_num", "home_team", "home_team_league", "home_team_game_num", "day_night",
    "postponement_cancellation", "date_of_makeup",
)
PARK_CODE_FILE = ("park_id", "name", "nickname", "city", "state", "open", "close", "league", "notes")
EVENT_FILE = {"season": L, "event_type": S, "filename": S, "content": "binary"}
EVENT_SUFFIXES = {
    "regular": (".EVA", ".EVN"),
    "post": ("CS.EVE", "D1.EVE", "D2.EVE", "W1.EVE", "W2.EVE", "WS.EVE"),
    "asg": ("AS.EVE",),
}

# Game-log columns in file order; one name is irregular in the landed files.
GAME_LOG_FILE = (
    "date", "game_num", "day_of_week", "visiting_team", "visiting_team_league", "visiting_team_game_num",
    "home_team", "home_team_league", "home_team_game_num", "visiting_score", "home_score", "num_outs",
    "day_night", "completion_info", "forfeit_info", "protest_info", "park_id", "attendance",
    "time_of_game_minutes", "visiting_line_score", "home_line_score", "visiting_abs", "visiting_hits",
    "visiting_doubles", "visiting_triples", "visiting_homeruns", "visiting_rbi", "visiting_sac_hits",
    "visiting_sac_flies", "visiting_hbp", "visiting_bb", "visiting_iw", "visiting_k", "visiting_sb",
    "visiting_cs", "visiting_gdp", "visiting_ci", "visiting_lob", "visiting_pitchers_used",
    "visiting_individual_er", "visiting_er", "visiting_wp", "visiting_balks", "visiting_po",
    "visiting_assists", "visiting_errors", "visiting_pb", "visiting_dp", "visiting_tp", "home_abs",
    "home_hits", "home_doubles", "home_triples", "home_homeruns", "home_rbi", "home_sac_hits",
    "home_sac_flies", "home_hbp", "home_bb", "home_iw", "home_k", "home_sb", "home_cs", "home_gdp", "home_ci",
    "home_lob", "home_pitchers_used", "home_individual_er", "home_er", "home_wp", "home_balks", "home_po",
    "home_assists", "home_errors", "home_pb", "home_dp", "home_tp", "ump_home_id", "ump_home_name",
    "ump_first_id", "ump_first_name", "ump_second_id", "ump_second_name", "ump_third_id", "ump_third_name",
    "ump_lf_id", "ump_lf_name", "ump_rf_id", "ump_rf_name", "visiting_manager_id", "visiting_manager_name",
    "home_manager_id", "home_manager_name", "winning_pitcher_id", "winning_pitcher_name", "losing_pitcher_id",
    "losing_pitcher_name", "save_pitcher_id", "save_pitcher_name", "game_winning_rbi_id",
    "game_winning_rbi_name", "visiting_starting_pitcher_id", "visiting_starting_pitcher_name",
    "home_starting_pitcher_id", "home_starting_pitcher_name", "visiting_1_id", "visiting_1_name",
    "visiting_1_pos", "visiting_2_id", "visiting_2_name", "visiting_2_pos", "visiting_2_id.1",
    "visiting_3_name", "visiting_3_pos", "visiting_4_id", "visiting_4_name", "visiting_4_pos", "visiting_5_id",
    "visiting_5_name", "visiting_5_pos", "visiting_6_id", "visiting_6_name", "visiting_6_pos", "visiting_7_id",
    "visiting_7_name", "visiting_7_pos", "visiting_8_id", "visiting_8_name", "visiting_8_pos", "visiting_9_id",
    "visiting_9_name", "visiting_9_pos", "home_1_id", "home_1_name", "home_1_pos", "home_2_id", "home_2_name",
    "home_2_pos", "home_3_id", "home_3_name", "home_3_pos", "home_4_id", "home_4_name", "home_4_pos",
    "home_5_id", "home_5_name", "home_5_pos", "home_6_id", "home_6_name", "home_6_pos", "home_7_id",
    "home_7_name", "home_7_pos", "home_8_id", "home_8_name", "home_8_pos", "home_9_id", "home_9_name",
    "home_9_pos", "misc", "acquisition_info",
)

# Types of stat-table columns by name or by the part after the last "_".
STAT_INTEGERS = (
    "G", "Game", "NumPlayers", "AB", "R", "H", "2B", "3B", "HR", "RBI", "BB", "IBB", "SO", "HBP",
    "SH", "SF", "ROE", "GDP", "SB", "CS", "LOB", "PA", "BF", "Pit", "Str", "DoublePlays", "PO", "A",
    "E", "DP", "W", "L", "SV", "Hld", "Pitches", "Strikes", "DoP", "Val", "IR", "IS", "GB", "FB",
    "LD", "PU",
)
STAT_DOUBLES = (
    "BA", "OBP", "SLG", "OPS", "ERA", "IP", "UQR", "WPA", "aLI", "WPA+", "WPA-", "RE24", "REW",
    "BLI", "pHat", "GSc", "Ctct", "StS", "StL",
)
STAT_GUARDED_SUFFIXES = ("Str", "Val", "Game", "W", "L", "E", "A", "R", "H", "DP", "IP")
STAT_GUARD_WORDS = ("basic", "advanced", "value", "standard", "group2")
STAT_TEXT = ("mlbID",)
STAT_LEFT_ALONE = ("Home",)

# Historical archive, one CSV per table.
ARCHIVE_TABLES = (
    "core/Parks.csv", "core/AllstarFull.csv", "core/Appearances.csv", "contrib/AwardsManagers.csv",
    "contrib/AwardsPlayers.csv", "contrib/AwardsShareManagers.csv", "contrib/AwardsSharePlayers.csv",
    "core/Batting.csv", "core/BattingPost.csv", "contrib/CollegePlaying.csv", "core/Fielding.csv",
    "core/FieldingOF.csv", "core/FieldingOFsplit.csv", "core/FieldingPost.csv",
    "contrib/HallOfFame.csv", "core/HomeGames.csv", "core/Managers.csv", "core/ManagersHalf.csv",
    "core/People.csv", "core/Pitching.csv", "core/PitchingPost.csv", "contrib/Salaries.csv",
    "contrib/Schools.csv", "core/SeriesPost.csv", "core/Teams.csv", "upstream/Teams.csv",
    "core/TeamsFranchises.csv", "core/TeamsHalf.csv",
)

# First and last day of each season.
SEASONS = {
    2008: ("2008-03-25", "2008-10-27"),
    2009: ("2009-04-05", "2009-11-04"),
    2010: ("2010-04-04", "2010-11-01"),
    2011: ("2011-03-31", "2011-10-28"),
    2012: ("2012-03-28", "2012-10-28"),
    2013: ("2013-03-31", "2013-10-30"),
    2014: ("2014-03-22", "2014-10-29"),
    2015: ("2015-04-05", "2015-11-01"),
    2016: ("2016-04-03", "2016-11-02"),
    2017: ("2017-04-02", "2017-11-01"),
    2018: ("2018-03-29", "2018-10-28"),
    2019: ("2019-03-20", "2019-10-30"),
    2020: ("2020-07-23", "2020-10-27"),
    2021: ("2021-04-01", "2021-11-02"),
    2022: ("2022-04-07", "2022-11-05"),
    2023: ("2023-03-30", "2023-11-01"),
    2024: ("2024-03-28", "2024-10-30"),
    2025: ("2025-03-27", "2025-11-01"),
    2026: ("2026-03-26", "2026-11-01"),
}
UNKNOWN_SEASON = ("03-15", "11-15")

# Clip table.
PLAYBACK = "struct<name:string,url:string,bitrate:bigint,width:bigint,height:bigint>"

# Ready-made leaderboards that are only ingested.
LEADERBOARDS = (
    "exitvelo_barrels", "expected_stats", "pitch_arsenal_stats", "bat_tracking", "run_value",
    "sprint_speed", "running_splits", "base_stealing", "fielding_run_value", "directional_oaa",
    "catch_probability", "outfielder_jump", "poptime", "catcher_framing", "catcher_blocking",
    "pitch_tempo", "arm_strength", "baserunning_run_value", "catcher_throwing", "catcher_stance",
    "outs_above_average",
)
PLACEHOLDER_PLAYER = 999_999
