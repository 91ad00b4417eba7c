"""Climate normals, anomalies and drought indices as PySpark DataFrame pipelines."""
