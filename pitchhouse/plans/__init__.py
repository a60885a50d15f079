"""The layers' transformations and the analytic queries, as functions of
DataFrames (bronze → silver → gold → reports)."""
