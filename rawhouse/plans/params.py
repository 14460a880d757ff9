"""Parameters of the registered queries (the reference's ``${var}`` values).

They are typed Python values handed to the operators, never spliced into SQL
text on the Spark side.
"""

TARGET_YEAR = 1998          # ${target_year}
PERIOD = 10                 # ${period} for per-entity series
CATEGORY_PERIOD = 30        # ${period} for per-category series
TARGET_ENTITY = 1           # ${target_stock}: a supplier key
TOP_K = 100                 # top entities by mean volume
TARGET_ARTIST = "Supplier#000000001"   # ${artist_target}
TOP_ITEMS = 10
TOP_TAGS = 20
TOP_NAMES = 20
KMEANS_K = 8                # well below the number of entities at every scale
KMEANS_SEED = 7
DIGITS = 6                  # output rounding of floating results
