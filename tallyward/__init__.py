"""Quality control of longitudinal form data on Spark."""
