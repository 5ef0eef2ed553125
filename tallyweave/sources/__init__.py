"""Where data comes from and goes to: staged tables, landed JSON, versioned tables, snapshots."""
