"""Fixed values that results must carry unchanged."""

# Table markers of the schedule pages, tried in this order.
SCHEDULE_TABLE_IDS = ["ctl00_c_Schedule1_GridView1", "ctl04_GridView1"]
SCHEDULE_TABLE_CLASS = "table-striped"
BASE_TABLE_CLASS = "ezl-base-table"
GRID_TABLE_ID = "ctl00_ContentPlaceHolder1_gvGames"
EVENTS_HEADER = "Events on"
CELL_LABEL_ATTRIBUTE = "data-th"
CELL_LABELS = ["league", "home", "away", "time/status", "venue", "officials"]
DATED_CELL_PREFIXES = ["Sat-", "Sun-"]

# Separators and placeholders of descriptions and scores.
VERSUS = " vs "
DASH = " - "
UNKNOWN_SIDE = "Unknown"
PRACTICE = "Practice"

# Month abbreviations, January first.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Validation of a parsed game: required fields and messages.
REQUIRED_FIELDS = ["date", "league_name", "home_team", "away_team", "field"]
MISSING_FIELD = "Missing required field: "
BAD_DATE = "Invalid date format"
SAME_TEAM = "Home team and away team are the same"
BAD_FIELD = "Invalid field format"
FIELD_PREFIX = "Field"

# Outcome labels.
HOME_WIN = "Home Win"
AWAY_WIN = "Away Win"
DRAW = "Draw"

# Patterns of the status report.
TIME_LIKE = r"^\d{1,2}:\d{2}\s*(?:AM|PM)?$"
SCORE_LIKE = r"\d+-\d+"

# Range planning limits.
DEFAULT_BATCH_DAYS = 3
MIN_BATCH_DAYS = 1
MAX_BATCH_DAYS = 10
DEFAULT_CHUNK_DAYS = 90
TRAILING_DAYS = 2
