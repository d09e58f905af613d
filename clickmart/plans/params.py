"""Report and exploration parameters used by the registered queries."""

from clickmart.sources.feeds import session_id_for

REPORT_START = "2024-01-08 00:00:00"
REPORT_END = "2024-01-15 00:00:00"
TOP_N = 10
TOP_IPS = 5
JOURNEY_SESSION = session_id_for(7, 1)
DETAIL_IP = "10.0.0.7"
CAMPAIGNS = ("campaign_0", "campaign_1")
SOURCES = ("facebook", "google", "bing")  # of the derived feed: the columns its oracle expects

# Membership selections for the filter reports (None selects NULL as well).
FILTER_EVENTS = ("add product", "go cart", "confirmation payment", None)
FILTER_OS = ("iOS", "Android", "Linux")
FILTER_BROWSERS = ("Chrome", "Safari")
USERS_OS = ("iOS", "Android", "Windows")
USERS_SOURCES = ("facebook", "google", None)
BROKEN_EVERY = 97  # of the load report: events whose location line is broken
