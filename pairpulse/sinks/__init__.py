"""Tables, their layout, staging of validated rows, and the CSV extract."""
