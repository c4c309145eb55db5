from pyspark.sql import types as T

from clickscope.schemas import USER_VISIT_ACTION

ACTION_WITH_ID = T.StructType([T.StructField("event_id", T.LongType()), *USER_VISIT_ACTION.fields])


def action(event_id, session_id="s1", page_id=1, action_time=None, user_id=1, click_category_id=-1,
           click_product_id=-1, order_category_ids=None, pay_category_ids=None, city_id=1,
           date="2019-03-20", search_keyword=None):
    t = action_time or f"2019-03-20 10:00:{event_id:02d}"
    return (event_id, date, user_id, session_id, page_id, t, search_keyword, click_category_id,
            click_product_id, order_category_ids, None, pay_category_ids, None, city_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, ACTION_WITH_ID)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
