"""Clinical waveform cohorts, labels, features and outcome statistics as Spark plans."""
