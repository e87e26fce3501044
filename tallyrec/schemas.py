"""Declared table layouts (the CREATE TABLE statements of the original jobs)."""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


STAGING = _s(("post_id", StringType()), ("cim_id", StringType()), ("post_order", IntegerType()),
             ("post_title", StringType()), ("permalink", StringType()), ("sim_score", DoubleType()),
             ("pred_rating", DoubleType()), ("more_explore", IntegerType()))
HOSTED_STAGING = _s(("cim_id", StringType()), ("post_id", StringType()), ("permalink", StringType()),
                    ("score", DoubleType()), ("post_order", IntegerType()))
SEED_LOG = _s(("cim_id", StringType()), ("post_id", StringType()))
PRODUCTION = _s(("cim_id", StringType()), ("email", StringType()), ("subscriber_id", StringType()),
                ("post_id", StringType()), ("permalink", StringType()), ("post_title_mod", StringType()),
                ("post_title", StringType()), ("image_url", StringType()), ("post_order", IntegerType()),
                ("sim_score", DoubleType()), ("pred_rating", DoubleType()), ("more_explore", IntegerType()),
                ("send_date", TimestampNTZType()), ("import_time_stamp", TimestampNTZType()))
HOSTED_PRODUCTION = _s(("cim_id", StringType()), ("email", StringType()), ("subscriber_id", StringType()),
                       ("post_id", StringType()), ("permalink", StringType()), ("post_title", StringType()),
                       ("image_url", StringType()), ("post_order", IntegerType()), ("score", DoubleType()),
                       ("send_date", TimestampNTZType()), ("import_time_stamp", TimestampNTZType()))
OUTBOUND = _s(("email", StringType()), ("post_title", StringType()), ("valid", IntegerType()),
              ("send_date", TimestampNTZType()), ("image_url", StringType()), ("url", StringType()),
              ("slugs", StringType()), ("position", IntegerType()), ("test_group", StringType()),
              ("post_type", StringType()), ("post_id", StringType()), ("subscriber_id", StringType()),
              ("received", StringType()))
EVENT_EXPORT = _s(("user_id", StringType()), ("item_id", StringType()), ("event_type", StringType()),
                  ("timestamp", LongType()))
ITEM_EXPORT = _s(("item_id", StringType()), ("is_expired", IntegerType()), ("slug_lst", StringType()))
