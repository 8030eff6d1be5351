"""recordloom.sources"""
