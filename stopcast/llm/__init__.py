"""Training-data operators: dedup, archives, search, token counts and files,
toxicity, personal data and decontamination, each as a Spark job.  Nothing
else in the library imports this subpackage."""
