"""What several test modules share; a module of its own name, as each folder has its own conftest."""

SF = "/root/testdata/sf0.001"

#: Sixteen records: one batch of ten and one of six.
GOLDEN = [f'{{"uid":"{1000 + n}","name":"n{n}","code":"{n}"}}' for n in range(1, 17)]


def messages_frame(spark, values, start="2024-01-01 00:00:00"):
    rows = [(n, value) for n, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "event_id long, value string")
    return frame.selectExpr(
        "event_id", f"timestampadd(SECOND, cast(event_id as int), timestamp'{start}') as ts", "value"
    )
