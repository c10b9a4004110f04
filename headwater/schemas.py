"""Schemas of the fact tables. Never inferred at read time."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

LISTENER_EVENT = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("event_ms", T.LongType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("execution_id", T.LongType()),
        T.StructField("properties", STRING_MAP),
        T.StructField("result", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("conf", STRING_MAP),
    ]
)

PLAN_NODE = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("execution_id", T.LongType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("node_kind", T.StringType()),
        T.StructField("relation_kind", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("options", STRING_MAP),
        T.StructField("root_paths", T.ArrayType(T.StringType())),
        T.StructField("has_catalog_table", T.BooleanType()),
    ]
)

RDD_NODE = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("rdd_id", T.LongType()),
        T.StructField("rdd_class", T.StringType()),
        T.StructField("rdd_name", T.StringType()),
        T.StructField("input_paths", T.ArrayType(T.StringType())),
    ]
)

RDD_EDGE = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("rdd_id", T.LongType()),
        T.StructField("dep_rdd_id", T.LongType()),
        T.StructField("dep_pos", T.IntegerType()),
    ]
)

RDD_OUTPUT = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("final_stage_kind", T.StringType()),
        T.StructField("old_api_path", T.StringType()),
        T.StructField("new_api_path", T.StringType()),
    ]
)

CONF_KV = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# Event names as Spark writes them to its event log.
APP_START = "SparkListenerApplicationStart"
APP_END = "SparkListenerApplicationEnd"
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
ENVIRONMENT = "SparkListenerEnvironmentUpdate"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"

JOB_FAILED = "JobFailed"
JOB_SUCCEEDED = "JobSucceeded"
EXECUTION_ID_KEY = "spark.sql.execution.id"
