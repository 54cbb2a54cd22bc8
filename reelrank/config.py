"""Fixed values that results depend on, plus job configuration loading.

The values in the block below must stay as they are for results to match
the behaviour being reproduced.
"""

from __future__ import annotations

import json
import os

# ---- fixed values (behavioural constants) --------------------------------
GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]
GENRE_TOP_K = 10            # best movies kept per genre
USER_MAX_RECOMMENDATION = 20  # ALS list length per user
MAX_USER_RATINGS_NUM = 20   # recent ratings considered per event
MAX_SIM_MOVIES_NUM = 20     # candidates drawn from the similarity list
ITEM_SIM_THRESHOLD = 0.6    # keep item pairs with similarity strictly above
RERANK_SIM_THRESHOLD = 0.7  # pairs that count when re-ranking
RERANK_UP_SCORE = 3.0       # ratings strictly above count as "up", else "down"
ALS_RANK = 50
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.01
# User and item blocks of a fit. ALS draws its start factors per block, so the
# model depends on this number: it is a parameter, never taken from the cluster.
ALS_NUM_BLOCKS = 10
ALS_GRID_RANKS = [20, 50, 100]
ALS_GRID_REG_PARAMS = [0.001, 0.01, 0.1]
ALS_GRID_MAX_ITER = 50
ALS_TRAIN_FRACTION = 0.8
HASHING_TF_FEATURES = 50
MOVIE_FIELD_SEP = "^"
MESSAGE_FIELD_SEP = "|"
LIST_SEP = "|"
STREAM_BATCH_INTERVAL = "2 seconds"
# --------------------------------------------------------------------------


def load_job_config(path: str | None = None) -> dict:
    """Read connection settings from a JSON file or RECS_* variables.

    Credentials never live in code; a job gets them from its deployment.
    """
    cfg: dict = {}
    if path:
        with open(path, encoding="utf-8") as fh:
            cfg.update(json.load(fh))
    for key, value in os.environ.items():
        if key.startswith("RECS_"):
            cfg[key[5:].lower()] = value
    return cfg
