"""Results kept between runs, brought up to date by what is new."""
