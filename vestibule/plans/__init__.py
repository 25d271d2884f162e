"""The four reports and the job that runs them all."""
