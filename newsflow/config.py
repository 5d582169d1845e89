"""Fixed values that must equal the studied pipeline's settings.

These are parameters of the data semantics, not tuning knobs: changing one
changes results.  Every operator takes them as keyword defaults so a caller
can override them explicitly.
"""

# --- fixed values (thresholds, model settings, formats) --------------------
MIN_CONTENT_CHARS = 50        # training keeps length(content) > 50
MIN_TEXT_CHARS = 100          # ingest cleaning keeps length(text) > 100
MIN_FEED_TEXT_CHARS = 30      # feed extraction keeps len(text) >= 30
ENTRIES_PER_FEED = 10         # first ten entries of each feed
KEY_PREFIX_CHARS = 50         # message key = first 50 characters of title
NUM_FEATURES = 5000           # HashingTF width
MIN_DOC_FREQ = 5              # IDF minDocFreq
SMOOTHING = 1.0               # Naive Bayes additive smoothing
TRAIN_FRACTION = 0.8          # 80/20 split
SPLIT_SEED = 42
ARTICLE_DATE_FORMAT = "MMMM dd, yyyy"   # Python "%B %d, %Y"
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
LABEL_FAKE = "FAKE"           # prediction 0.0
LABEL_TRUE = "TRUE"           # anything else
TRAIN_BUCKETS = 100           # hash split: bucket < TRAIN_PERCENT -> train
TRAIN_PERCENT = 80

# Triggers of the three long-running jobs.
SCORE_TRIGGER = "30 seconds"
INGEST_PARQUET_TRIGGER = "1 minute"
INGEST_CSV_TRIGGER = "5 minutes"
FEED_POLL_TRIGGER = "2 minutes"
DEDUPE_DELAY = "1 hour"              # D2: copies of a title no further apart are one article
DEDUPE_KEEP = "1 day"                # D2: how long a title is remembered that gets no more copies
