"""Defaults that callers may override."""

# These must equal what running deployments already use.
BROKERS = "localhost:29092"
TOPIC = "econ.indicators"
CONSUMER_GROUP = "econ-consumer-1"
SINK = "console"
WINDOW_WIDTH = "1 minute"
WINDOW_SLIDE = "30 seconds"
LATENESS = "2 minutes"
PARQUET_TRIGGER = "30 seconds"
CONSOLE_TRIGGER = "10 seconds"
DIGITS = 4
RESPONSE_PAGE = 100

# Our own: changed windows of a micro-batch that the console shows.
CONSOLE_ROWS = 1000

# Code, display name, base value.
CATALOGUE = [
    ("base_rate", "기준금리", 3.5),
    ("usd_krw", "원달러환율", 1350.0),
    ("kospi", "코스피", 2600.0),
    ("cpi", "소비자물가지수", 114.0),
]
