"""One raw match that tests change."""

BASE_MATCH = {
    "Season": "2015/16", "MatchDate": "2015-08-08", "HomeTeam": "A", "AwayTeam": "B",
    "FullTimeHomeGoals": 1, "FullTimeAwayGoals": 0, "FullTimeResult": "H",
    "HalfTimeHomeGoals": 0, "HalfTimeAwayGoals": 0, "HalfTimeResult": "D",
    "HomeShots": 10, "AwayShots": 8, "HomeShotsOnTarget": 4, "AwayShotsOnTarget": 3,
    "HomeCorners": 5, "AwayCorners": 4, "HomeFouls": 9, "AwayFouls": 11,
    "HomeYellowCards": 1, "AwayYellowCards": 2, "HomeRedCards": 0, "AwayRedCards": 0,
}
