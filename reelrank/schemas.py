"""Fixed schemas of the data model (movie, rating, tag and result lists)."""

MOVIE = ("mid INT, name STRING, descri STRING, timelong STRING, issue STRING, shoot STRING, "
         "language STRING, genres STRING, actors STRING, directors STRING")
RATING = "uid INT, mid INT, score DOUBLE, timestamp INT"
TAG = "uid INT, mid INT, tag STRING, timestamp INT"

MOVIE_COLUMNS = ["mid", "name", "descri", "timelong", "issue", "shoot", "language",
                 "genres", "actors", "directors"]
RATING_COLUMNS = ["uid", "mid", "score", "timestamp"]
TAG_COLUMNS = ["uid", "mid", "tag", "timestamp"]

RECOMMENDATION = "struct<mid:int,score:double>"
RECOMMENDATION_USER = "struct<uid:int,score:double>"

# List sizes and thresholds of the reference jobs.
MAX_USER_RATINGS_NUM = 20        # recent ratings per user
MAX_SIM_MOVIES_NUM = 20          # candidate similar movies per event
GENRE_TOP_K = 10                 # movies per genre
CONTENT_SIM_THRESHOLD = 0.6      # cosine kept in the similarity table
STREAM_SIM_THRESHOLD = 0.7       # cosine used by the real-time score
ALS_TOP_K = 50                   # list length of the offline recommendations
HASHING_FEATURES = 50            # hashed term buckets

# The reference's genre list, in its order.
DEFAULT_GENRES = ["Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama",
                  "Family", "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery",
                  "Romance", "Science", "Tv", "Thriller", "War", "Western"]
