"""Text operators for training-data pipelines: de-duplication, decontamination,
personal data, quality, toxicity and tokenisation.  Nothing outside this folder
imports it."""
