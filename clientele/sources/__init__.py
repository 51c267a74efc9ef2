"""Reading exports and keeping dated snapshots."""
