"""newsmill.sources"""
