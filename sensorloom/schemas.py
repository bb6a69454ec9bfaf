"""Row shapes shared by every module, and the fixed values of the data model."""

from pyspark.sql import types as T

# Column names, types and formats that stored data and messages already use.
READING = (
    T.StructType()
    .add("sensor_id", "string")
    .add("temperature", "float")
    .add("humidity", "float")
    .add("timestamp", "string")
)
LABELLED = (
    T.StructType()
    .add("timestamp", "string")
    .add("sensor_id", "string")
    .add("temperature", "float")
    .add("humidity", "float")
    .add("is_anomaly", "integer")
)
SCORED = (
    T.StructType()
    .add("timestamp", "string")
    .add("sensor_id", "string")
    .add("temperature", "float")
    .add("humidity", "float")
    .add("is_anomaly_predicted", "integer")
)
LINE = T.StructType().add("line", "string")
REJECTED = T.StructType().add("value", "string")
FEATURES = ("temperature", "humidity")
LABEL = "is_anomaly"
PREDICTED = "is_anomaly_predicted"
MEASUREMENT = "sensor_measurement"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
