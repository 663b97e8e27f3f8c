"""tabscope: data profiling as Spark DataFrame jobs."""
