"""Parameters of the registered queries (shared by the Spark plans and the
oracle SQL so the two always agree)."""

AS_OF = "2001-08-02"            # "now" for recency over the order history
EVENTS_AS_OF = "2024-01-31"     # "now" for the web-event history
SESSION_GAP_SECONDS = 6 * 3600  # inactivity gap that closes a session
EVENT_RANGE = ("2024-01-05", "2024-01-25")   # I01 extract window
ORDER_RANGE = ("1997-01-01", "1998-12-31")   # I02 extract window
COST_RATIO = 0.6
SAMPLE_CUSTOMER = 42            # P06: the customer whose sessions are shown
SEGMENT_FILTER = "Champions"    # P05
MIN_SUPPORT = 0.01              # M05 (API default)
MIN_CONFIDENCE = 0.15           # M05: near the data's own, so that pairs remain
MIN_LIFT = 0.95                 # M05
MAX_PAIRS = 1000                # M05 (configured)
TOP_PAIRS = 20                  # M05 (API default)
CROSS_SELL_K = 3                # M06
RETENTION_PERIODS = 12          # C06
MIN_COHORT_SIZE = 10            # C06
ALERT_MIN_CONVERSION = 0.25     # T08
ALERT_MAX_ABANDONMENT = 0.2     # T08
SNAPSHOT_DATES = ("2000-01-01", "2001-01-01")  # SCD2 snapshots (D03/D04)
