"""No streaming operators: the workloads are batch, and nothing here keeps state between runs."""
