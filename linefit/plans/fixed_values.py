"""Settings of the programs."""

# Results are comparable only with exactly these.
LINE_WIDTH = 13
FIRST_YEAR = 1922
LABEL_FIELD = 0
FEATURE_FIELDS = [1, 2, 3]
CSV_FEATURE_FIELDS = [1, 2, 3, 4, 5, 6]
YEARS_COUNTED = (1998, 2000)
YEARS_LISTED = (2000, 2010)
AGE_BOUND = 70
REG_PARAMS = [0.005, 0.05, 0.08, 0.1, 0.15, 0.3, 0.5]
MAX_ITERS = [3, 5, 8, 10, 25, 50, 75]
FOLDS = 3
ELASTIC_NET = {"regParam": 0.1, "elasticNetParam": 0.1}
ELASTIC_NET_ITERATIONS = 10
CSV_ELASTIC_NET_ITERATIONS = 3
GRADIENT_ITERATIONS = 100
SPLIT_7_3 = [0.7, 0.3]
SPLIT_9_1 = [0.9, 0.1]
TUNING_SEED = 12345
CSV_SEED = 1515
CSV_COLUMNS = [
    "Year", "SongNumber", "SongID", "AlbumID", "AlbumName", "ArtistID", "ArtistLatitude",
    "ArtistLocation", "ArtistLongitude", "ArtistName", "Danceability", "Duration",
    "KeySignature", "KeySignatureConfidence", "Tempo", "TimeSignature",
    "TimeSignatureConfidence", "Title",
]
CSV_IDENTITY = ["SongNumber", "SongID"]
CSV_DROPPED = [
    "SongNumber", "SongID", "AlbumID", "AlbumName", "ArtistID", "ArtistLatitude",
    "ArtistLocation", "ArtistLongitude", "ArtistName", "Danceability", "Title",
]
CSV_PACKED = [
    "Year", "Duration", "KeySignature", "KeySignatureConfidence", "Tempo", "TimeSignature",
    "TimeSignatureConfidence",
]
