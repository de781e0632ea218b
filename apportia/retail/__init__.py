"""Order, party and event tables read as tax documents."""
