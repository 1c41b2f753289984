"""leafwork: auditing, ranking, reconciling and releasing page-sourced tables on Spark."""
