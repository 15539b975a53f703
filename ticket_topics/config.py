"""Parameters shared by the jobs."""

# Topic names and their ids.
TOPICS = (
    (0, "Bank account services"),
    (1, "Credit card / Prepaid card"),
    (2, "Others"),
    (3, "Theft/Dispute reporting"),
    (4, "Mortgages/loans"),
)

N_TOPICS = 5
TOPIC_SEED = 40
TOP_TERMS = 15

SPLIT_SEED = 42
LR_MAX_ITER = 10

BOOTSTRAP_REPLICATES = 5
BOOTSTRAP_FRACTION = 0.1
BOOTSTRAP_SEED = 7
ALPHA = 0.05
METRICS = ("accuracy", "precision", "recall", "f1")

RATE_WINDOW_SECONDS = 300
RATE_THRESHOLD = 0.3
QUIET_SECONDS = 600
WATERMARK = "10 minutes"

# A table is broadcast only when it was measured to be below both bounds.
BROADCAST_ROWS = 1 << 20
BROADCAST_BYTES = 64 << 20
