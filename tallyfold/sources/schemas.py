"""Record layouts of the inputs."""

from pyspark.sql import types as T


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# comment_count stays text: older records hold "(N příspěvků)", newer ones an int.
ARTICLE = _row(
    url=_TEXT, title=_TEXT, content=_TEXT, category=_TEXT, image_count=_INT,
    publication_date=_TEXT, comment_count=_TEXT,
)
ARTICLE_MESSAGE = _row(
    url=_TEXT, title=_TEXT, content=_TEXT, category=_TEXT, image_count=_INT,
    publication_date=T.TimestampType(), comment_count=_INT,
)
ARRIVAL_MESSAGE = _row(
    url=_TEXT, title=_TEXT, content=_TEXT, category=_TEXT, photo_count=_INT,
    time=T.TimestampType(), comment_count=_INT,
)
ORDER_LINE = _row(customer_id=_INT, order_id=_INT, price=T.DecimalType(18, 2))
RATING = _row(user=_INT, movie=_INT, score=_INT, time=_LONG)
MOVIE = _row(movie_id=_INT, title=_TEXT)
HERO_NAME = _row(id=_INT, name=_TEXT)
PERSON = _row(userID=_INT, name=_TEXT, age=_INT, friends=_INT)
